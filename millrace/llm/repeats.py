"""Removal of byte strings that occur twice, with suffix arrays.

1. Anchors: of the 40-byte pieces of each window of 200 bytes, the one with the least hash is the
   window's anchor. Equal windows have equal anchors, at the same place, so a window can only
   repeat if its anchor's piece does. Pieces are counted over all texts.
2. Contexts: neighbouring windows with one anchor make up a context, of 360 bytes at most. Those
   with a repeated anchor are kept; equal contexts are one, with a count.
3. Shards: distinct contexts are dealt to shards by their anchor. Each shard builds the suffix
   array of its contexts by Larsson-Sadakane refinement and their common prefixes by Kasai's rule
   (see suffix_array): a window is repeated if it shares 200 bytes with a neighbour, or if its
   context has a count of two.
4. An anchor with more than SHARD_CONTEXTS contexts is spread over several shards. These publish
   their distinct windows, from their suffix arrays, in parts by digest, as many as the anchor's own shards ask
   for. Equal windows have equal anchors, so the sorted lists of one part of one anchor meet, and no others; they are
   merged by binary search: a window whose digest is found twice in the merged list is repeated.
5. The windows' places go back to the texts, and their union is what is removed.

Memory is bounded by shards; no step drops rows. Pieces and contexts are told apart by 64-bit hashes in 1
and 2, windows by their bytes in 3 and by 128-bit digests in 4: their bytes would be 90 times those of the contexts.

Nulls: a null text counts as empty. Equal texts are repeats of each other. Texts of fewer than 200
bytes keep all. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import mapped, row_of, text_key, written
from .suffix_array import kasai, refine
from .words import Prefix, U, byte_table, mix, raw, slices

PIECE = 40
SHARD_BYTES = 4 << 20
SHARD_CONTEXTS = 4096
PART_BYTES = 1 << 20
FILTER_BITS = 26
#: Values of bytes for the second half of a digest.
SECOND = mix((np.arange(256, dtype=U) + U(1)) * U(0xBF58476D1CE4E5B9)) | U(1)


def anchors(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[Prefix, np.ndarray, np.ndarray, np.ndarray]:
    """Of strings laid end to end: prefix hashes, and for each context its anchor and the first
    and last start of its windows."""
    prefix = Prefix(byte_table(False)[data])
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < window:
        return prefix, none, none, none
    width = window - PIECE + 1
    # the 40 upper bits are of the hash, the lower ones of the place: the least is the leftmost of the least
    value = prefix.all(PIECE)
    value &= ~U((1 << 24) - 1)
    value |= np.arange(len(value), dtype=U)
    blocks = -(-len(value) // width)
    filled = np.full(blocks * width, ~U(0))
    filled[: len(value)] = value
    square = filled.reshape(blocks, width)
    head = np.minimum.accumulate(square, axis=1).ravel()
    tail = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    begin = np.arange(n - window + 1)
    least = np.minimum(tail[begin], head[begin + width - 1])
    room = np.repeat(offsets[1:], np.diff(offsets))[: len(begin)] - begin
    at = (least & U((1 << 24) - 1)).astype(np.int64)
    good = room >= window
    begin, at = begin[good], at[good]
    if not len(begin):
        return prefix, none, none, none
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (begin[1:] != begin[:-1] + 1)))
    return prefix, at[new], begin[new], begin[np.append(new[1:], len(begin)) - 1]


def parts(texts: pa.Array, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets, rows and place in the row, of pieces of PART_BYTES at most; a longer text is
    cut so that each window is whole in one piece."""
    data, offsets = raw(texts)
    if len(data) <= PART_BYTES:
        yield data, offsets, np.arange(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64)
        return
    for row in range(len(offsets) - 1):
        for low in range(offsets[row], max(offsets[row + 1] - window + 1, offsets[row] + 1), PART_BYTES - window):
            high = min(low + PART_BYTES - 1, offsets[row + 1])
            yield data[low:high], np.array([0, high - low]), np.array([row]), np.array([low - offsets[row]])


def _repeated_anchors(docs: DataFrame, text: str, window: int) -> np.ndarray:
    """A bitmap of fixed size, 8 MB, with a bit set for each repeated anchor. With more of them it
    only lets more through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            for data, offsets, _, _ in parts(batch.column(0), window):
                prefix, at, _, _ = anchors(data, offsets, window)
                if len(at):
                    name, n = np.unique(prefix.of(at, at + PIECE), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n.astype(np.int64))], ["anchor", "n"])

    counted = mapped(docs.select(F.col(text).alias("_text")), run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")
    bits = counted.select(F.pmod("anchor", F.lit(1 << FILTER_BITS)).alias("bit"))
    rows = bits.groupBy(F.expr("int(bit div 32)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(bit % 32)))").alias("bits")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return words


def _contexts(docs: DataFrame, text: str, window: int) -> DataFrame:
    """anchor, context (a hash), text_id, first (place of the context) and data (its bytes, at its
    first place in a task) of all contexts with a repeated anchor."""
    bits = docs.sparkSession.sparkContext.broadcast(_repeated_anchors(docs, text, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            key = batch.column(1)
            for data, offsets, rows, places in parts(batch.column(0), window):
                prefix, at, low, high = anchors(data, offsets, window)
                anchor = prefix.of(at, at + PIECE)
                bit = anchor % U(1 << FILTER_BITS)
                good = np.flatnonzero(bits.value[(bit >> U(5)).astype(np.int64)] >> (bit & U(31)).astype(np.uint32) & np.uint32(1))
                if not len(good):
                    continue
                at, low, high, anchor = at[good], low[good], high[good] + window, anchor[good]
                context = mix(prefix.of(low, high) + mix(anchor) * U(3) + (at - low).astype(U))
                piece = np.searchsorted(offsets, low, "right") - 1
                _, first = np.unique(context, return_index=True)
                own = np.zeros(len(low), bool)
                own[first] = True
                block = data.tobytes()
                stored = [block[a:b] if o else None for a, b, o in zip(low.tolist(), high.tolist(), own.tolist(), strict=True)]
                place = low - offsets[piece] + places[piece]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), key.take(pa.array(rows[piece])), pa.array(place), pa.array(stored, pa.binary())],
                    ["anchor", "context", "text_id", "first", "data"],
                )

    rows = docs.select(F.col(text).alias("_text"), F.unhex(text_key(F.col(text))).alias("text_id"))
    return written(mapped(rows, run, "anchor long, context long, text_id binary, first long, data binary"), "contexts")


RANGES = "context long, low int, high int"


def _ranges(context: np.ndarray, start: np.ndarray) -> pa.Table:
    """Runs of window starts (sorted within each context) as ranges, the last start included."""
    if not len(start):
        return pa.table({"context": pa.array([], pa.int64()), "low": pa.array([], pa.int32()), "high": pa.array([], pa.int32())})
    new = np.flatnonzero(np.append(True, (context[1:] != context[:-1]) | (start[1:] != start[:-1] + 1)))
    last = np.append(new[1:], len(start)) - 1
    return pa.table({"context": context[new], "low": start[new].astype(np.int32), "high": start[last].astype(np.int32)})


def _windows(table: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a shard's contexts: their bytes, the room behind each, the context's number, and the sorted windows."""
    data = np.frombuffer(b"".join(table.column("data").to_pylist()), np.uint8)
    sizes = table.column("size").to_numpy()
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    room = ends[owner] - np.arange(len(data))
    order, _ = refine(data, room, window)
    return data, room, owner, order


def _shard_ranges(window: int):
    """A function for applyInArrow: repeated windows of a shard as ranges of starts in its contexts."""

    def run(table: pa.Table) -> pa.Table:
        data, room, owner, order = _windows(table, window)
        common = kasai(data, room, order)
        same = np.append(common[1:] >= window, False) | (common >= window)
        hit = np.zeros(len(data), bool)
        hit[order[same]] = True
        hit |= (table.column("n").to_numpy() > 1)[owner] & (room >= window)
        at = np.flatnonzero(hit)
        begin = np.append(0, np.cumsum(table.column("size").to_numpy()))[owner[at]]
        return _ranges(table.column("context").to_numpy()[owner[at]], at - begin)

    return run


def _published(window: int):
    """The hashes of a shard's distinct windows with their places, in four parts for each shard of the anchor."""

    def run(table: pa.Table) -> pa.Table:
        data, room, owner, order = _windows(table, window)
        common = kasai(data, room, order)
        at = order[common < window]  # equal windows are neighbours: the first of each
        name, second = (Prefix(t[data]).of(at, at + window) for t in (byte_table(False), SECOND))
        by = np.lexsort((second, name))
        at, name, second = at[by], name[by], second[by]
        begin = np.append(0, np.cumsum(table.column("size").to_numpy()))[owner[at]]
        context, start = table.column("context").to_numpy()[owner[at]], (at - begin).astype(np.int32)
        part = (name % U(4 * table.column("pieces")[0].as_py())).astype(np.int64)
        by = np.argsort(part, kind="stable")
        found, low = np.unique(part[by], return_index=True)
        cut = lambda x: pa.array([x[by][a:b].tobytes() for a, b in zip(low, np.append(low[1:], len(by)), strict=True)], pa.binary())
        anchor = np.full(len(found), table.column("anchor")[0].as_py(), np.int64)
        return pa.table({"anchor": anchor, "part": found, "names": cut(name), "seconds": cut(second), "contexts": cut(context), "starts": cut(start)})

    return run


def _merged(table: pa.Table) -> pa.Table:
    """Places of the windows that two lists have, of the lists of one part of one anchor; a list is sorted and has none twice."""
    lists = lambda column, kind: [np.frombuffer(x, kind) for x in table.column(column).to_pylist()]
    names, seconds = lists("names", U), lists("seconds", U)
    whole = np.concatenate(names)
    order = np.lexsort((np.concatenate(seconds), whole))
    whole, other = whole[order], np.concatenate(seconds)[order]
    met = []
    for name, second in zip(names, seconds, strict=True):
        low, high = np.searchsorted(whole, name), np.searchsorted(whole, name, "right")
        same = np.zeros(len(name), np.int64)
        for step in range(int((high - low).max(initial=0))):  # as many as lists have the first half of a digest
            at = np.minimum(low + step, len(whole) - 1)
            same += (low + step < high) & (other[at] == second)
        met.append(same > 1)
    met = np.concatenate(met)
    context, start = np.concatenate(lists("contexts", np.int64))[met], np.concatenate(lists("starts", np.int32))[met].astype(np.int64)
    order = np.lexsort((start, context))
    return _ranges(context[order], start[order])


def spans(docs: DataFrame, *, text: str = "text", window: int = 200) -> DataFrame:
    """text_id (of the text) and ranges (first byte, byte behind the last; they may overlap) of all
    windows that occur twice, once for each text that has any."""
    placed = _contexts(docs, text, window)
    distinct = placed.groupBy("context").agg(F.count("*").alias("n"), F.first("anchor").alias("anchor"), F.first("data", ignorenulls=True).alias("data"))
    distinct = written(distinct.withColumn("size", F.octet_length("data")), "distinct")
    per_anchor = distinct.groupBy("anchor").agg(F.count("*").alias("contexts"), F.sum("n").alias("places")).filter("places > 1")
    per_anchor = written(per_anchor.select(F.col("anchor").alias("of"), F.ceil(F.col("contexts") / SHARD_CONTEXTS).cast("long").alias("pieces")), "anchors")
    total = distinct.agg(F.sum("size")).first()[0] or 0
    shards = max(12, total // SHARD_BYTES * 2 + 1)
    kept = distinct.join(per_anchor, F.col("anchor") == F.col("of"))
    many = kept.filter("pieces > 1").withColumn("piece", F.pmod(F.xxhash64("context"), F.col("pieces")))
    few = kept.filter("pieces = 1").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    columns = ("shard", "context", "n", "size", "data")
    found = few.select(*columns).groupBy("shard").applyInArrow(_shard_ranges(window), RANGES)
    if not per_anchor.filter("pieces > 1").isEmpty():
        spread = many.select("anchor", "piece", "pieces", *columns[1:]).groupBy("anchor", "piece")
        found = found.union(spread.applyInArrow(_shard_ranges(window), RANGES))
        published = spread.applyInArrow(_published(window), "anchor long, part long, names binary, seconds binary, contexts binary, starts binary")
        found = found.union(published.groupBy("anchor", "part").applyInArrow(_merged, RANGES))
    found = written(found, "ranges")
    places = written(placed.select("context", "text_id", "first").distinct(), "places")
    met = places.join(found, "context").select("text_id", (F.col("first") + F.col("low")).alias("a"), (F.col("first") + F.col("high") + window).alias("b"))
    return met.groupBy("text_id").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("ranges"))


def union(ranges: list[dict]) -> list[tuple[int, int]]:
    """Sorted ranges as maximal runs."""
    out: list[list[int]] = []
    for r in ranges:
        if out and r["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["b"])
        else:
            out.append([r["a"], r["b"]])
    return [tuple(x) for x in out]


def remove(docs: DataFrame, *, text: str = "text", window: int = 200) -> DataFrame:
    """``docs`` with kept (the bytes that stay), n_bytes, n_removed, n_spans and kept_sha256 in place of the text."""
    found = written(spans(docs, text=text, window=window), "spans")
    results = ("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    keyed = docs.select(row_of(docs, text, *results), F.col(text).cast("binary").alias("bytes"), F.unhex(text_key(F.col(text))).alias("key"))
    joined = keyed.join(found.hint("shuffle_hash"), F.col("key") == F.col("text_id"), "left")
    rows = joined.select("row", "bytes", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for data, ranges in zip(batch.column("bytes").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                data, runs = data or b"", union(ranges or [])
                at, pieces = 0, []
                for a, b in runs:
                    pieces.append(data[at:a])
                    at = b
                kept = b"".join([*pieces, data[at:]])
                values.append((kept, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            new = [pa.array(c, k) for c, k in zip(zip(*values, strict=True), kinds, strict=True)] if values else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *new], ["row", *results])

    types = (T.BinaryType(), T.LongType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType([rows.schema["row"], *[T.StructField(k, v) for k, v in zip(results, types, strict=True)]])
    return mapped(rows, run, schema).select("row.*", *results)
