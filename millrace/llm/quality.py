"""Quality rules: measures of each text, and the frequency of lines across the documents of a host.

A line is normalised (A-Z lower-cased, white space collapsed) and hashed; each document counts it
once, and an exact copy is a document like any other. A line in more than ``least`` documents of its
host and in more than ``share`` of them is removed, and so is one in more than ``most`` of them,
however large the host is. A document that keeps less than ``left`` of its words is rejected.

Nulls: a null text has no words; a null host is a host of its own. Equal rows get equal verdicts.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import mapped, row_of, text_key, written
from .words import NOT_SPACE, Prefix, Words, mix, repeated, slices

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LINES = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int32()), ("at", pa.int32()), ("first", pa.int32())]))


def _apart(row: np.ndarray) -> np.ndarray:
    """A value for each row, so that what is equal in two rows differs."""
    return row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _later(keys: np.ndarray) -> np.ndarray:
    """True for the values that equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    later = np.zeros(len(keys), bool)
    later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return later


def measures(texts: pa.Array) -> tuple[list[np.ndarray], pa.Array]:
    """The columns of MEASURES, and the lines with a word: normalised hash, words, number of the line,
    and 1 for the first of equal ones in the text, else 0."""
    words = Words(texts, NOT_SPACE, fold=False)
    data, offsets, rows = words.bytes, words.offsets, len(words.counts)
    starts_char = words.inside & ((data & 0xC0) != 0x80)
    line_end = data == 10

    bound = np.zeros(len(data) + 1, bool)
    bound[offsets[:-1][np.diff(offsets) > 0]] = True
    bound[1:][line_end] = True
    bound[-1:] = False
    begin = np.flatnonzero(bound)
    row = np.searchsorted(offsets, begin, "right") - 1
    end = np.append(begin[1:], len(data))[: len(begin)]
    end = np.minimum(end, offsets[row + 1])
    stop = end - ((end > begin) & line_end[np.maximum(end - 1, 0)] if len(data) else 0)
    number = np.arange(len(begin)) - np.searchsorted(row, row)
    low, high = np.searchsorted(words.start, begin), np.searchsorted(words.start, end)
    full = high > low
    begin, stop, row, number, low, high = (x[full] for x in (begin, stop, row, number, low, high))

    later = _later(mix(words.hashes(begin, stop, False) + _apart(row)))

    at, window = words.windows(3)
    twice = at[repeated(mix(window + _apart(words.doc[at])))]
    covered = np.zeros(len(words.hash) + 3, bool)
    for j in range(3):
        covered[twice + j] = True

    hashes = Prefix(words.hashes(words.start, words.end, True)).of(low, high)
    first = (~_later(mix(hashes + _apart(row)))).astype(np.int32)
    counts = np.bincount(row, minlength=rows)
    lines = pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(hashes.view(np.int64)), pa.array((high - low).astype(np.int32)), pa.array(number.astype(np.int32)), pa.array(first)], fields=list(LINES.value_type)),
    )
    values = [
        words.counts,
        words.sums(starts_char),
        words.sums(SYMBOLS[data]),
        np.bincount(row[later], minlength=rows),
        words.word_sums(covered[: len(words.hash)]),
    ]
    return [v.astype(np.int64) for v in values], lines


def profile(docs: DataFrame, *, text: str = "text", key: str = "doc_id", host: str = "source") -> DataFrame:
    """One row per row of ``docs``: rid, id, host, the text's key, MEASURES and the lines."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("id"), F.col(host).alias("host"), F.unhex(text_key(F.col(text))).alias("text_id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            values, lines = measures(batch.column("_text"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *map(pa.array, values), lines], [*batch.schema.names[:4], *MEASURES, "lines"])

    kept = rows.schema["id"].dataType.simpleString(), rows.schema["host"].dataType.simpleString()
    schema = f"rid long, id {kept[0]}, host {kept[1]}, text_id binary, {', '.join(f'{m} long' for m in MEASURES)}, lines array<struct<hash:long,words:int,at:int,first:int>>"
    return written(mapped(rows, run, schema), "quality")


def judge(profiled: DataFrame, *, least: int = 20, share: float = 0.1, most: int = 10_000, left: float = 0.3) -> DataFrame:
    """``profiled`` without its lines, with base_failed, removed_words, removed (numbers of lines) and kept."""
    line = profiled.select("rid", "host", F.explode("lines").alias("l")).select("rid", "host", "l.*")
    seen = line.groupBy("host", "hash").agg(F.sum("first").alias("n")).filter(F.col("n") > least)
    hosts = profiled.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("documents"))
    limit = F.least(F.lit(share) * F.col("documents"), F.lit(most))
    frequent = seen.join(hosts, F.col("host").eqNullSafe(F.col("of"))).filter(F.col("n") > limit).select("of", F.col("hash").alias("common"))
    hits = line.join(frequent, F.col("host").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("common")), "left_semi")
    hits = hits.groupBy("rid").agg(F.sum("words").alias("removed_words"), F.collect_list("at").alias("removed"))
    base = F.coalesce((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")), F.lit(False))
    judged = profiled.drop("lines").join(hits, "rid", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    depleted = F.col("n_words") - F.col("removed_words") < F.lit(left) * F.col("n_words")
    return judged.withColumn("base_failed", base).withColumn("kept", ~base & ~depleted)


def clean(docs: DataFrame, *, text: str = "text", key: str = "doc_id", host: str = "source", **limits) -> DataFrame:
    """The kept rows of ``docs``, their text without the removed lines; same columns."""
    verdicts = judge(profile(docs, text=text, key=key, host=host), **limits)
    verdicts = verdicts.groupBy("host", "text_id").agg(F.first("kept").alias("kept"), F.first("removed").alias("removed"))
    keyed = docs.select(row_of(docs), F.col(host).alias("of"), F.unhex(text_key(F.col(text))).alias("key"))
    joined = keyed.join(verdicts, F.col("of").eqNullSafe(F.col("host")) & (F.col("key") == F.col("text_id"))).filter("kept")
    content = F.col("row").getField(text)
    lines = F.filter(F.split(content, "\n", -1), lambda _, i: ~F.array_contains("removed", i))
    cut = F.when(F.col("removed").isNull(), content).otherwise(F.array_join(lines, "\n"))
    return joined.select(*[cut.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


SQL = """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
l AS (SELECT rid, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS at FROM d),
lw AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words,
  translate(array_to_string(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM l),
f AS (SELECT * FROM lw WHERE words > 0),
dup AS (SELECT rid, sum(n - 1) AS n_dup FROM (SELECT rid, line, count(*) AS n FROM f GROUP BY ALL) GROUP BY rid),
hosts AS (SELECT source, count(*) AS n FROM d GROUP BY source),
freq AS (SELECT c.source, c.norm FROM (SELECT source, norm, count(DISTINCT rid) AS n FROM f GROUP BY ALL) c
  JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source WHERE c.n > 20 AND c.n > least(0.1::double * h.n, 10000)),
gone AS (SELECT f.rid, sum(words) AS words FROM f JOIN freq ON f.source IS NOT DISTINCT FROM freq.source AND f.norm = freq.norm GROUP BY f.rid),
g AS (SELECT rid, i, ws[i:i+2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid),
m AS (SELECT w.doc_id, len(ws)::bigint AS n_words, coalesce(length(array_to_string(ws, '')), 0)::bigint AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols, coalesce(n_dup, 0)::bigint AS n_dup_lines,
  coalesce(rep.n, 0)::bigint AS n_repeat_words, coalesce(gone.words, 0)::bigint AS removed_words
  FROM w LEFT JOIN dup ON w.rid = dup.rid LEFT JOIN rep ON w.rid = rep.rid LEFT JOIN gone ON w.rid = gone.rid)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_words - removed_words < 0.3::double * n_words) AS kept FROM m
"""
