"""Similarity join on word shingles: exact components of Jaccard similarity 0.75 and more.

1. Each text becomes its set of 64-bit shingle hashes; equal sets are one set from here on.
2. Screening: of n hashes, the lowest n/4 + l, with l = n/12 + 1, are dealt to slices by hash.
   Similar sets share l of these at least, so a set of which fewer occur elsewhere has no partner.
   What is left is mostly near copies.
3. Their full sets are dealt to slices, which give each hash its number of sets. In the order of
   that number, similar sets share one of their first n/4 + 1 hashes; sets that share one are joined
   into candidate groups (see components).
4. In each group, a signature tree (see signature_tree) finds the links. A group beyond GROUP_SETS
   or GROUP_TOKENS is cut into blocks: each block first by itself, then one set of each block's main
   class, by levels of blocks, then all sets outside the group's main class against every block, in parts.

No step drops sets, tokens or pairs, and each task's memory is bounded by slices, groups and
blocks, but for a hash that few sets of each flush have and many of all: its owners meet in one slice when hashes
are counted. Hashes are dealt in flushes of SLICE_TOKENS, and a frequent hash is worked on within each
flush first: in screening and grouping a slice gets one or two marks of a flush that has it several
times; before hashes are counted, the MOST_HOT that most sets have (of those that are frequent in some
flush) are set apart: they come last in the order without being counted. So a line in all texts
doesn't meet in one slice.

Two sets, or two shingles, get one hash with a probability of 2**-64 a pair.

A text of fewer than five words has one shingle, the whole; without words it has none, and is
linked with nothing. Nulls: a null text has no words; a null id is kept, and a component's id is
its smallest id that isn't null. Equal rows stay separate rows. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected, roots
from .shared import Tables, mapped, row_of, text_key, written
from .signature_tree import links
from .words import NOT_SPACE, U, Words, mix, slices

GROUP_SETS = 512
GROUP_TOKENS = 1 << 17
SLICE_TOKENS = 1 << 19
FILTER_BITS = 26
#: Bytes of a hash that are dealt in screening.
LOW_BYTES = 6
#: A hash is looked at as a hot one if so many sets of a flush have it, and is one if so many sets have it in all.
HOT_HERE, HOT = 64, 4096
MOST_HOT = 1 << 18
#: Rows of a small table that is broadcast; a larger one is shuffled.
MOST_BROADCAST = 1_000_000


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, NOT_SPACE, fold=True)
    at, hashes = words.windows(size)
    first = np.searchsorted(at, words.first)
    out = [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    for i in np.flatnonzero((words.counts > 0) & (words.counts < size)):
        whole = np.zeros(1, U)
        for j, h in enumerate(words.hash[words.first[i] : words.first[i + 1]]):
            whole = mix(whole + h + U(j + 1))
        out[i] = whole
    return out


def set_id(hashes: np.ndarray) -> int:
    return int((mix(hashes ^ U(0x5851F42D4C957F2D)).sum(dtype=U) ^ U(len(hashes))).view(np.int64))


def fewest(n, percent: int):
    """The fewest tokens that a set of n shares with a similar one."""
    return -(-n * percent // 100)


# flushes and slices -------------------------------------------------------------------------------

DEALT = "part int, flush long, tokens binary, at binary, names binary, sizes binary, counts binary"
COLUMNS = [x.split(" ")[0] for x in DEALT.split(", ")]
KINDS = [pa.int32(), pa.int64(), *[pa.binary()] * 5]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (part, flush, arrays in the order of DEALT or None)."""
    plain = [(part, flush, *(None if x is None else x.tobytes() for x in arrays)) for part, flush, *arrays in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*plain, strict=True), KINDS, strict=True)], COLUMNS)


def _cut(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Each value of ``part`` with its values of the columns."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    here, start = np.unique(part[order], return_index=True)
    for p, a, b in zip(here.tolist(), start.tolist(), [*start[1:].tolist(), len(part)], strict=True):
        yield p, *(x[order[a:b]] for x in columns)


def _narrow(token: np.ndarray, width: int) -> np.ndarray:
    """The lower bytes of each token."""
    return token if width == 8 else np.ascontiguousarray(token.view(np.uint8).reshape(-1, 8)[:, :width])


def _wide(data: bytes, width: int) -> np.ndarray:
    if width == 8:
        return np.frombuffer(data, U)
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view(U).ravel()


class Flush:
    """Some sets' tokens, sorted: ``token``, ``at`` (number of the set), and ``start`` and ``length`` of each token's run."""

    def __init__(self, found: list[np.ndarray]):
        token = np.concatenate(found)
        at = np.repeat(np.arange(len(found)), [len(x) for x in found])
        order = np.argsort(token, kind="stable")
        self.token, self.at = token[order], at[order].astype(np.uint16)
        self.start, self.length = _run_lengths(self.token)


def _run_lengths(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    return start, np.diff(np.append(start, len(ordered)))


def _dealer(tokens: Callable[[pa.RecordBatch], Iterator[tuple[int, int, np.ndarray]]], deal: Callable[[int, list[int], list[int], list[np.ndarray]], list[tuple]]):
    """A mapInArrow function that gathers (set, size, tokens) of rows in flushes and deals these out.
    A flush's number is that of its partition and its place in it, so that a task that runs again gives the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush = TaskContext.get().partitionId() << 24
        names, sizes, found, total = [], [], [], 0
        for batch in batches:
            for name, size, x in tokens(batch):
                names.append(name)
                sizes.append(size)
                found.append(x)
                total += len(x)
                if total >= SLICE_TOKENS or len(names) == 1 << 16:
                    if rows := deal(flush, names, sizes, found):
                        yield _batch(rows)
                    names, sizes, found, total = [], [], [], 0
                    flush += 1
        if names and (rows := deal(flush, names, sizes, found)):
            yield _batch(rows)

    return run


def _rows_of(table: pa.Table) -> Iterator[tuple]:
    """part, flush and bytes of each row."""
    for batch in table.to_batches():
        yield from zip(*(batch.column(name).to_pylist() for name in COLUMNS), strict=True)


def _slice(table: pa.Table, width: int) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """The rows of a slice that only pass through it; and its tokens, sorted, with their flushes and numbers of sets."""
    passing, token, flush, at = [], [], [], []
    for row in _rows_of(table):
        if row[4] is not None:
            passing.append(row)
        else:
            token.append(_wide(row[2], width))
            at.append(np.frombuffer(row[3], np.uint16))
            flush.append(np.full(len(token[-1]), row[1], np.int64))
    if not token:
        none = np.zeros(0, np.int64)
        return passing, none.astype(U), none, none.astype(np.uint16)
    token, flush, at = (np.concatenate(x) for x in (token, flush, at))
    order = np.argsort(token, kind="stable")
    return passing, token[order], flush[order], at[order]


def _shared(token: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted tokens: the length of each one's run, and whether it has two owners at least."""
    start, length = _run_lengths(token)
    two = np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start) if len(start) else np.zeros(0, bool)
    return np.repeat(length, length), np.repeat(two, length)


# steps --------------------------------------------------------------------------------------------


def profile(docs: DataFrame, *, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 75) -> DataFrame:
    """id, text_id, n_shingles and set of each row; the first row of a set in a task has its screening hashes."""
    rows = docs.select(F.col(key).alias("id"), F.unhex(text_key(F.col(text))).alias("text_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "_text"):
            sets = shingle_sets(batch.column("_text"), size)
            names = [set_id(x) if len(x) else None for x in sets]
            low = []
            for name, x in zip(names, sets, strict=True):
                if name is None or name in seen:
                    low.append(None)
                    continue
                seen.add(name)
                n = len(x)
                low.append(_narrow(x[: n - fewest(n, percent) + n // 12 + 1] >> U(64 - 8 * LOW_BYTES), LOW_BYTES).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([len(x) for x in sets], pa.int64()), pa.array(names, pa.int64()), pa.array(low, pa.binary())], ["id", "text_id", "n_shingles", "set", "low"])

    return mapped(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, text_id binary, n_shingles long, `set` long, low binary")


def _screened(profiled: DataFrame, percent: int) -> DataFrame:
    """The sets that may have a partner."""
    low = profiled.filter("low IS NOT NULL").select("set", "n_shingles", "low")
    parts = (low.agg(F.sum(F.octet_length("low"))).first()[0] or 0) // LOW_BYTES // SLICE_TOKENS + 1

    def tokens(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        for name, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield name, n, _wide(data, LOW_BYTES)

    def deal(flush: int, names: list[int], sizes: list[int], found: list[np.ndarray]) -> list[tuple]:
        """A token that two sets of the flush have is counted here; its slice gets a mark of two sets that don't exist."""
        here, owner = Flush(found), np.array(names, np.int64)
        _, two = _shared(here.token, owner[here.at])
        met = np.bincount(here.at[two], minlength=len(names)).astype(np.uint32)
        first = np.zeros(len(here.token), bool)
        first[here.start] = True
        mark = here.token[first & two]
        one = ~two
        token, at = np.concatenate([here.token[one], mark, mark]), np.concatenate([here.at[one], np.repeat(np.array([65534, 65535], np.uint16), len(mark))])
        rows = [(part, flush, _narrow(t, LOW_BYTES), a, None, None, None) for part, t, a in _cut((token % U(parts)).astype(np.int32), token, at)]
        return [*rows, (flush % parts, flush, None, None, owner, np.array(sizes, np.int64), met)]

    def count(table: pa.Table) -> pa.Table:
        passing, token, flush, at = _slice(table, LOW_BYTES)
        _, two = _shared(token, flush << 16 | at)
        out = [(0, row[1], None, None, *(np.frombuffer(x, np.uint8) for x in row[4:])) for row in passing]
        out += [(0, f, None, a, None, None, None) for f, a in _cut(flush[two], at[two])]
        return pa.Table.from_batches([_batch(out)] if out else [], pa.schema(list(zip(COLUMNS, KINDS, strict=True))))

    def kept(table: pa.Table) -> pa.Table:
        name = size = met = None
        more = []
        for row in _rows_of(table):
            if row[4] is None:
                more.append(np.frombuffer(row[3], np.uint16))
            else:
                name, size, met = np.frombuffer(row[4], np.int64), np.frombuffer(row[5], np.int64), np.frombuffer(row[6], np.uint32)
        n = met + np.bincount(np.concatenate([*more, np.zeros(0, np.uint16)]), minlength=1 << 16)[: len(name)]
        return pa.table({"set": name[n >= fewest(size, percent) // 12 + 1]})

    flushes = mapped(low, _dealer(tokens, _capped(deal)), DEALT).groupBy("part").applyInArrow(count, DEALT)
    return flushes.groupBy("flush").applyInArrow(kept, "`set` long").distinct()


def _capped(deal):
    """The two last numbers of a flush's sets are marks, so a fuller flush is dealt as two."""

    def run(flush: int, names: list[int], sizes: list[int], found: list[np.ndarray]) -> list[tuple]:
        if len(names) <= 65534:
            return deal(flush, names, sizes, found)
        half = len(names) // 2
        return [*deal(flush, names[:half], sizes[:half], found[:half]), *deal(flush | 1 << 23, names[half:], sizes[half:], found[half:])]

    return run


def _filter_bits(sets: DataFrame) -> np.ndarray:
    """A bitmap of fixed size, 8 MB, with a bit set for each of the sets. With more sets it only
    lets more through; an exact join follows."""
    bits = sets.select(F.pmod(F.col("set"), F.lit(1 << FILTER_BITS)).alias("bit"))
    rows = bits.groupBy(F.expr("int(bit div 32)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(bit % 32)))").alias("bits")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return words


def _full_sets(docs: DataFrame, candidates: DataFrame, text: str, size: int) -> DataFrame:
    """set, size and hashes of each candidate, once."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(candidates))
    rows = docs.select(F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "_text"):
            names, lengths, data = [], [], []
            for x in shingle_sets(batch.column(0), size):
                if not len(x) or (name := set_id(x)) in seen:
                    continue
                at = name % (1 << FILTER_BITS)
                if bits.value[at >> 5] >> np.uint32(at & 31) & np.uint32(1):
                    seen.add(name)
                    names.append(name)
                    lengths.append(len(x))
                    data.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(lengths, pa.int64()), pa.array(data, pa.binary())], ["set", "size", "hashes"])

    found = mapped(rows, run, "`set` long, size long, hashes binary").join(candidates, "set", "left_semi")
    return found.groupBy("set").agg(F.first("size").alias("size"), F.first("hashes").alias("hashes"))


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    for name, n, data in zip(*(batch.column(c).to_pylist() for c in ("set", "size", "hashes")), strict=True):
        yield name, n, np.frombuffer(data, U)


def _hot(sets: DataFrame) -> np.ndarray:
    """The hashes of HOT sets and more, at most the MOST_HOT most frequent, of those that HOT_HERE sets of a flush have."""

    def deal(flush: int, names: list[int], sizes: list[int], found: list[np.ndarray]) -> list[tuple]:
        here = Flush(found)
        often = here.length >= HOT_HERE
        return [(0, flush, here.token[here.start[often]], here.length[often].astype(np.int64), None, None, None)] if often.any() else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _dealer(_tokens, deal)(batches):
            token, n = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64) for c in ("tokens", "at"))
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(n)], ["token", "n"])

    counted = mapped(sets, run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT)
    return np.sort(counted.orderBy(F.desc("n"), "token").limit(MOST_HOT).select("token").toArrow().column(0).to_numpy().view(U))


def _groups(sets: DataFrame, percent: int) -> DataFrame:
    """a and b, edges that join the sets of each candidate group: those that share one of their rarest hashes."""
    spark = sets.sparkSession
    parts = (sets.agg(F.sum("size")).first()[0] or 0) // SLICE_TOKENS + 1
    hot = spark.sparkContext.broadcast(_hot(sets))

    def deal(flush: int, names: list[int], sizes: list[int], found: list[np.ndarray]) -> list[tuple]:
        here = Flush(found)
        apart = np.isin(here.token, hot.value)
        token, at = here.token[~apart], here.at[~apart]
        rows = [(part, flush, t, a, None, None, None) for part, t, a in _cut((token % U(parts)).astype(np.int32), token, at)]
        return [*rows, (flush % parts, flush, here.token[apart], here.at[apart], np.array(names, np.int64), np.array(sizes, np.int64), None)]

    def frequencies(table: pa.Table) -> pa.Table:
        """The slice's tokens that two sets have, with their numbers of sets, back to their flushes."""
        passing, token, flush, at = _slice(table, 8)
        length, two = _shared(token, flush << 16 | at)
        out = [(0, row[1], *(None if x is None else np.frombuffer(x, np.uint8) for x in row[2:])) for row in passing]
        count = np.minimum(length, 65534).astype(np.uint16)
        out += [(0, f, t, a, None, None, n) for f, t, a, n in _cut(flush[two], token[two], at[two], count[two])]
        return pa.Table.from_batches([_batch(out)] if out else [], pa.schema(list(zip(COLUMNS, KINDS, strict=True))))

    def rarest(table: pa.Table) -> pa.Table:
        """The first tokens of each set of a flush, the rarest first. Sets of the flush that share one
        are joined here, and the least of them goes to the token's slice."""
        name = size = None
        token, at, count = [], [], []
        for row in _rows_of(table):
            token.append(np.frombuffer(row[2], U))
            at.append(np.frombuffer(row[3], np.uint16))
            if row[4] is None:
                count.append(np.frombuffer(row[6], np.uint16))
            else:
                name, size = np.frombuffer(row[4], np.int64), np.frombuffer(row[5], np.int64)
                count.append(np.full(len(at[-1]), 65535, np.uint16))
        token, at, count = (np.concatenate(x) for x in (token, at, count))
        order = np.lexsort((token, count, at))
        token, at = token[order], at[order]
        own, start, n = np.unique(at, return_index=True, return_counts=True)
        most = size[own] - fewest(size[own], percent) + 1 - (size[own] - n)  # tokens that no other set has come first
        keep = np.arange(len(at)) - np.repeat(start, n) < np.repeat(most, n)
        token, owner = token[keep], name[at[keep]]
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        start, length = _run_lengths(token)
        hub = np.minimum.reduceat(owner, start) if len(start) else owner
        a, b = np.repeat(hub, length), owner
        own = a != b
        rows = [(p, 0, t, None, h, None, None) for p, t, h in _cut((token[start] % U(parts)).astype(np.int32), token[start], hub)]
        if own.any():
            node, root = roots(a[own], b[own])
            rows.append((table.column("flush")[0].as_py() % parts, 0, None, None, root[node != root], node[node != root], None))
        return pa.Table.from_batches([_batch(rows)] if rows else [], pa.schema(list(zip(COLUMNS, KINDS, strict=True))))

    def stars(table: pa.Table) -> pa.Table:
        token, owner, a, b = [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row in _rows_of(table):
            if row[2] is None:
                a.append(np.frombuffer(row[4], np.int64))
                b.append(np.frombuffer(row[5], np.int64))
            else:
                token.append(np.frombuffer(row[2], U))
                owner.append(np.frombuffer(row[4], np.int64))
        if token:
            token, owner = np.concatenate(token), np.concatenate(owner)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            start, length = _run_lengths(token)
            hub = np.repeat(np.minimum.reduceat(owner, start), length)
            a.append(hub[hub != owner])
            b.append(owner[hub != owner])
        node, root = roots(np.concatenate(a), np.concatenate(b))
        return pa.table({"a": root[node != root], "b": node[node != root]})

    dealt = mapped(sets, _dealer(_tokens, deal), DEALT)
    shared = dealt.groupBy("part").applyInArrow(frequencies, DEALT)
    first = shared.groupBy("flush").applyInArrow(rarest, DEALT)
    return first.groupBy("part").applyInArrow(stars, "a long, b long")


FOUND = "a long, b long"


def _tree_links(members: DataFrame, percent: int) -> DataFrame:
    """Links between the sets of each ``grp`` of ``members`` (bin, grp, set, hashes, and class or null)."""

    def run(table: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        group = table.column("grp").to_numpy()
        order = np.argsort(group, kind="stable")
        name = table.column("set").to_numpy()[order]
        known = table.column("class").to_pylist()
        data = table.column("hashes")
        start, length = _run_lengths(group[order])
        for a, n in zip(start.tolist(), length.tolist(), strict=True):
            if n > 1:
                rows = order[a : a + n]
                sets = [np.frombuffer(data[int(i)].as_buffer(), U) for i in rows]
                classes = None if known[rows[0]] is None else np.array([known[i] for i in rows])
                found += [(int(name[a + i]), int(name[a + j])) for i, j in links(sets, percent, classes)]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return members.groupBy("bin").applyInArrow(run, FOUND)


def _pieces(n, tokens):
    """Into how many blocks so many sets and tokens are cut: no more than there are sets."""
    return F.least(n, F.ceil(F.greatest(n / GROUP_SETS, tokens / GROUP_TOKENS))).cast("long")


def _linked(sets: DataFrame, groups: DataFrame, percent: int, tables: Tables) -> DataFrame:
    """a and b of links that join all similar sets. ``groups``: node (set) and component (candidate group)."""
    none = F.lit(None).cast("long").alias("class")
    sized = tables(sets.select("set", "size").join(groups.select(F.col("node").alias("set"), "component"), "set"), "sized")
    per_group = sized.groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("tokens"))
    per_group = tables(per_group.withColumn("blocks", _pieces(F.col("n"), F.col("tokens"))), "groups")
    count, total = per_group.filter("blocks = 1").agg(F.sum("n"), F.sum("tokens")).first()
    bins = max(64, (total or 0) // GROUP_TOKENS * 2 + 1)
    place = sized.join(per_group.filter("blocks = 1"), "component").select("set", F.pmod(F.xxhash64("component"), F.lit(bins)).alias("bin"), F.col("component").alias("grp"))
    place = F.broadcast(place) if (count or 0) <= MOST_BROADCAST else place
    small = sets.join(place, "set").select("bin", "grp", "set", "hashes", none)
    found = tables(_tree_links(small, percent), "links")
    large = per_group.filter("blocks > 1")
    if large.isEmpty():
        return found

    where = sized.join(large, "component").select("set", "component", "blocks", F.pmod(F.xxhash64("set"), F.col("blocks")).alias("block"))
    cut = tables(sets.join(where, "set").select("component", "blocks", "block", "set", "size", "hashes"), "blocks")
    bin_of = lambda *c: F.xxhash64("component", *c)
    one = F.lit(0).cast("long").alias("grp")
    inner = tables(_tree_links(cut.select(bin_of("block").alias("bin"), one, "set", "hashes", none), percent), "inner")

    def classed(edges: DataFrame) -> DataFrame:
        joined = connected(edges, tables).select(F.col("node").alias("set"), F.col("component").alias("in"))
        return tables(cut.select("component", "block", "set", "size").join(joined, "set", "left").withColumn("in", F.coalesce("in", "set")), "classes")

    now = classed(inner)
    level = now.select("component", "block", "set", "size", "in")
    before = None
    while True:  # one set of each block's main class, in blocks again until each group's are in one
        main = level.groupBy("component", "block", "in").agg(F.count("*").alias("n"), F.min(F.struct("set", "size")).alias("one"))
        main = main.groupBy("component", "block").agg(F.max_by("one", F.struct("n", "one")).alias("one")).select("component", "one.*")
        many = main.groupBy("component").agg(_pieces(F.count("*"), F.sum("size")).alias("pieces"))
        heads = tables(main.join(many, "component").select("component", "set", "size", F.pmod(F.xxhash64("set", F.lit(3)), F.col("pieces")).alias("block"), "pieces"), "heads")
        most, sets_left = heads.agg(F.max("pieces"), F.count("*")).first()
        linked = _tree_links(heads.join(cut.select("set", "hashes"), "set").select(bin_of("block").alias("bin"), one, "set", "hashes", none), percent)
        inner = tables(inner.union(linked), "inner")
        if most == 1 or sets_left == before:
            break
        before = sets_left
        joined = connected(inner, tables).select(F.col("node").alias("set"), F.col("component").alias("in"))
        level = heads.join(joined, "set", "left").withColumn("in", F.coalesce("in", "set"))
    now = classed(inner)
    top = now.groupBy("component", "in").agg(F.count("*").alias("n")).groupBy("component").agg(F.max_by("in", F.struct("n", "in")).alias("top"))
    outside = now.join(top, "component").filter("in != top").select("component", "set", "size", "in")
    parts = outside.groupBy("component").agg(_pieces(F.count("*"), F.sum("size")).alias("parts"))
    classes = now.select("set", F.col("in").alias("class"))
    own = cut.join(parts, "component").join(classes, "set").withColumn("visit", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    guest = cut.join(outside.select("set"), "set", "left_semi").join(parts, "component").join(classes, "set").withColumn("visit", F.pmod(F.xxhash64("set", F.lit(7)), F.col("parts")))
    guest = guest.withColumn("home", F.col("block")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).filter("block != home").drop("home")
    both = own.unionByName(guest).select(bin_of("block", "visit").alias("bin"), one, "set", "hashes", "class")
    return found.union(inner).union(_tree_links(both, percent))


def components(docs: DataFrame, *, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 75) -> DataFrame:
    """``key``, text_id (md5 of the text), n_shingles and component_id of each row of ``docs``."""
    profiled = written(profile(docs, text=text, key=key, size=size, percent=percent), "shingles")
    with Tables(docs.sparkSession) as tables:
        candidates = tables(_screened(profiled, percent), "candidates")
        sets = tables(_full_sets(docs, candidates, text, size), "sets")
        groups = tables(connected(_groups(sets, percent), tables), "candidate-groups")
        found = connected(_linked(sets, groups, percent, tables), tables).select(F.col("node").alias("set"), F.col("component").alias("root"))
        least = profiled.filter("`set` IS NOT NULL").groupBy("set").agg(F.min("id").alias("least"))
        rooted = tables(least.join(found, "set", "left").withColumn("root", F.coalesce("root", "set")), "rooted")
        linked = written(rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("set", "component_id"), "linked")
    joined = profiled.select("id", "text_id", "n_shingles", "set").join(linked, "set", "left")
    return joined.select(F.col("id").alias(key), "text_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def representatives(docs: DataFrame, *, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 75) -> DataFrame:
    """One row of ``docs`` of each component, that with the smallest ``key``; of texts without words,
    every distinct row. Of rows with equal ``key`` and text, the one whose other columns come first
    as JSON stays, whatever the partitions."""
    found = components(docs, text=text, key=key, size=size, percent=percent)
    least = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "text_id")
    wordless = F.when(F.col("n_shingles") == 0, F.col("text_id"))
    kept = written(found.groupBy("component_id", wordless.alias("alone")).agg(F.min(least).alias("least")).select("least.*").distinct(), "representatives")
    keyed = docs.select(row_of(docs), F.col(key).alias("own"), F.unhex(text_key(F.col(text))).alias("content"))
    met = keyed.join(kept, F.col("own").eqNullSafe(F.col("id")) & (F.col("content") == F.col("text_id")), "left_semi")
    others = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in (text, key)]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    return met.groupBy("own", "content").agg(F.min_by("row", order).alias("row")).select("row.*")


SQL = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT rid, g FROM (
  SELECT rid, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)
  UNION ALL SELECT rid, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 4)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON x = nx.rid JOIN n ny ON y = ny.rid WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(node, root) AS (SELECT rid, rid FROM d UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.node),
m AS (SELECT r.node, min(d.doc_id) AS component_id FROM r JOIN d ON r.root = d.rid GROUP BY r.node)
SELECT d.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, m.component_id FROM d JOIN m ON d.rid = m.node LEFT JOIN n ON d.rid = n.rid
"""
