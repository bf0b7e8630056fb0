"""Sharding by vector bin packing over bytes, tokens and rows.

A group is the rows with one text. Groups with over 1 / ``singles`` of a dimension's total are placed
one by one, the largest first, each where its dot product with the residual capacity is highest;
there are at most three times ``singles`` of them, whatever the size of the table, and in a table of
up to ``singles`` rows and tokens it is nearly all. The others are placed in the same way in bundles,
by a hash of the group, of which there are ``bundles``. Only these bounded lists of sums meet on the
driver; the rows are then assigned where they are.

A group of more than one shard's share can't stay together if shards are to be equal: it is dealt
in pieces, by a hash of the row.

Tokens are those of ``tokenizer`` (the path of a .model or .json file, see token_counts), counted as
the rows are read; without one, runs without white space are counted instead.

Nulls: a null text counts as empty (no bytes, no tokens) and all null texts are one group; a null
id is kept. Equal rows are separate rows of one group. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .shared import mapped, spread, text_key, written
from .token_counts import encoder
from .words import slices

DIMENSIONS = ("size", "tokens", "one")


def place(items: np.ndarray, shards: int) -> list[int]:
    """A shard for each item (rows: its share of the total in each dimension), the largest first:
    that with the highest dot product of the item with the residual capacity."""
    residual = np.full((shards, items.shape[1]), 1.0 / shards)
    out = [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-items[i].max(), i)):
        out[i] = s = int(np.argmax(residual @ items[i]))
        residual[s] -= items[i]
    return out


def _counted(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` with the tokens of their content, which goes; equal texts of a task are encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known = encoder(tokenizer), {}
        for batch in slices(batches, "content"):
            group = batch.column("grp").to_pylist()
            new = {g: i for i, g in enumerate(group) if g not in known}
            texts = batch.column("content").take(pa.array(list(new.values()), pa.int64())).to_pylist()
            known.update((g, len(x)) for g, x in zip(new, encode(texts) if texts else [], strict=True))
            yield batch.drop_columns(["content"]).append_column("tokens", pa.array([known[g] for g in group], pa.int64()))

    return mapped(rows, run, StructType([*rows.schema.fields[:-1], StructField("tokens", LongType())]))


def pack(docs: DataFrame, shards: int = 8, *, text: str = "text", key: str = "doc_id", tokenizer: str | None = None, bundles: int = 4096, singles: int = 1 << 15) -> DataFrame:
    """``key``, size (UTF-8 bytes + 1), text_crc32, tokens, shard and slot (position in the shard) of each row."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(key).alias("id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.unhex(text_key(F.col(text))).alias("grp"),
        F.monotonically_increasing_id().alias("rid"),
        content.alias("content"),
    )
    if tokenizer is None:
        base = base.withColumn("tokens", F.regexp_count("content", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")).drop("content")
    else:
        base = _counted(spread(base), tokenizer)
    base = written(base, "sharding").withColumn("bundle", F.pmod(F.xxhash64("grp"), F.lit(bundles)).cast("int"))
    groups = base.withColumn("one", F.lit(1)).groupBy("grp", "bundle").agg(*[F.sum(d).alias(d) for d in DIMENSIONS])
    total = groups.agg(*[F.sum(d).alias(d) for d in DIMENSIONS]).first()
    total = [max(total[d] or 0, 1) for d in DIMENSIONS]
    heavy = F.greatest(*[F.col(d) / F.lit(t) for d, t in zip(DIMENSIONS, total, strict=True)]) > 1 / singles
    large = groups.filter(heavy).collect()
    small = groups.filter(~heavy).groupBy("bundle").agg(*[F.sum(d).alias(d) for d in DIMENSIONS]).collect()

    items, owners = [], []
    for row in sorted(large, key=lambda r: bytes(r["grp"])):
        share = np.array([row[d] / t for d, t in zip(DIMENSIONS, total, strict=True)])
        pieces = int(np.ceil(2 * shards * share.max())) if share.max() > 1 / shards else 1
        items += [share / pieces] * pieces
        owners += [bytes(row["grp"])] * pieces
    for row in sorted(small, key=lambda r: r["bundle"]):
        items.append(np.array([row[d] / t for d, t in zip(DIMENSIONS, total, strict=True)]))
        owners.append(row["bundle"])
    of_group: dict[bytes, list[int]] = {}
    of_bundle = [0] * bundles
    for owner, shard in zip(owners, place(np.array(items).reshape(-1, 3), shards), strict=True):
        if isinstance(owner, bytes):
            of_group.setdefault(owner, []).append(shard)
        else:
            of_bundle[owner] = shard

    lone = spark.createDataFrame([(bytearray(g), s) for g, s in of_group.items()], "grp binary, own array<int>")
    rest = spark.createDataFrame(list(enumerate(of_bundle)), "bundle int, common int")
    mixed = F.pmod(F.xxhash64("rid"), F.size("own")).cast("int")
    placed = base.join(F.broadcast(lone), "grp", "left").join(F.broadcast(rest), "bundle", "left")
    placed = placed.withColumn("shard", F.coalesce(F.when(F.col("own").isNotNull(), F.get("own", mixed)), F.col("common")))
    return slots(placed, total[2]).select(F.col("id").alias(key), "size", "text_crc32", "tokens", "shard", "slot")


def slots(placed: DataFrame, rows: int, each: int = 100_000) -> DataFrame:
    """Gapless positions in each shard: rows are numbered in parts of about ``each`` rows, and the
    parts' counts give each part its offset."""
    parts = max(8, rows // each)
    placed = placed.withColumn("part", F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(parts)).cast("int"))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("id", "rid")
    return placed.withColumn("at", F.row_number().over(within)).join(counts, ["shard", "part"]).withColumn("slot", F.col("offset") + F.col("at") - 1)
