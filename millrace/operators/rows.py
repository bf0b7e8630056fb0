"""Filters, splits, lookups and windows over rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import wildcard
from ..storage import written


def keep_latest(df: DataFrame, keys: Sequence[str], order: str, tie: str) -> DataFrame:
    """One row per key: the greatest ``order``, of equal ones the smallest ``tie``, of any type that has an order. Null
    keys are a key; a null ``order`` loses, and so does a null ``tie``. Aggregated before the shuffle, so a hot
    key costs nothing; a ``tie`` that isn't a whole number takes two aggregations, by key and order first."""
    rest = [F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)]
    whole = isinstance(df.schema[tie].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if whole:  # ~x falls as x rises, and has no overflow
        best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(order), F.bitwise_not(F.col(tie)))).alias("_row"))
    else:
        first = df.groupBy(*keys, F.col(order).alias("_order")).agg(F.min_by(F.struct(*rest), F.struct(F.col(tie).isNull(), F.col(tie))).alias("_row"))
        best = first.groupBy(*keys).agg(F.max_by("_row", F.struct("_order")).alias("_row"))
    return best.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(df.columns)])


def keep_last(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order``: the last in the order of files and lines, if that is the
    ordinal of ``jsonl.file_order``. A null key is an error."""
    checked = df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).select(F.raise_error(F.lit("null key")))
    if not checked.isEmpty():
        raise ValueError("null key")
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*").select(df.columns)


def complement(df: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(kept.select(*keys).distinct(), list(keys), "left_anti")


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): a null condition rejects, so that the two are the whole."""
    met = F.coalesce(condition, F.lit(False))
    return df.filter(met), df.filter(~met)


def excluded(sender: Column, subject: Column, rules: Sequence[tuple[str, str | None]]) -> Column:
    """A sender of ``rules`` without a pattern, or with one that the subject matches. Null: not excluded."""
    hits = [(sender == who) & (F.lit(True) if pattern is None else wildcard(subject, pattern)) for who, pattern in rules]
    return F.coalesce(reduce(lambda a, b: a | b, hits, F.lit(False)), F.lit(False))


def drop_lines(text: Column, patterns: Sequence[str], stop: str | None = None) -> Column:
    """Without lines that match one of ``patterns``, and without all from the first that matches ``stop``."""
    lines = F.split(text, "\n", -1)
    if stop:
        at = F.array_position(F.transform(lines, lambda x: x.rlike(stop)), True)
        lines = F.when(at > 0, F.slice(lines, F.lit(1), F.greatest(at - 1, F.lit(0)).cast("int"))).otherwise(lines)
    return F.array_join(F.filter(lines, lambda x: ~reduce(lambda a, b: a | b, [x.rlike(p) for p in patterns], F.lit(False))), "\n")


def lines_with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line: key, at, line and next (null for the last). Lines stay in their row's task."""
    lines = F.split(text, "\n", -1)
    pairs = F.transform(lines, lambda x, i: F.struct(i.alias("at"), x.alias("line"), F.get(lines, i + 1).alias("next")))
    return df.select(key, F.explode(pairs).alias("l")).select(key, "l.*")


def lookup(df: DataFrame, dimension: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Left join with a table of one row per key; ``strict``: a key without a row is an error."""
    if not strict:
        return df.join(dimension, key, "left")
    marked = df.join(dimension.withColumn("_found", F.lit(True)), key, "left")
    return marked.filter(F.when(F.col("_found").isNull(), F.raise_error(F.concat(F.lit("no row for "), F.col(key).cast("string")))).otherwise(F.lit(True))).drop("_found")


def lookup_or_error(df: DataFrame, dimension: DataFrame, key: str, code: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their dimension's, and the others with an error code."""
    return df.join(dimension, key), df.join(dimension.select(key), key, "left_anti").withColumn("error", F.lit(code))


class Tally:
    """Counts of rows, and of those that meet a condition, taken while frames are written: no scan of their own.

    ``watch`` the frames, write what comes of them, then read ``counts`` or ask for ``same``. A frame that is
    computed twice counts as often, so each is watched where it is written."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, **conditions: Column) -> DataFrame:
        self._seen[name] = seen = Observation()
        counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()]
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)

    def counts(self, name: str) -> dict[str, int]:
        """rows and a count for each condition; waits for the first write of the frame."""
        return dict(self._seen[name].get)

    def same(self, *names: str) -> int:
        """How many rows each of the frames had; an error if they had not the same number."""
        found = {n: self.counts(n)["rows"] for n in names}
        if len(set(found.values())) > 1:
            raise ValueError("numbers of rows differ: " + ", ".join(f"{n} {k}" for n, k in found.items()))
        return next(iter(found.values()))


def same_count(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df``, if it has as many rows as ``other``. Both are counted at once; where they are written anyway, ``Tally`` costs no scan."""
    rows = df.select(F.lit(1).alias("a"), F.lit(0).alias("b")).union(other.select(F.lit(0), F.lit(1)))
    a, b = rows.agg(F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    if a != b:
        raise ValueError(f"{a} rows, not {b}")
    return df


#: Rows of a group that are numbered in one task.
GROUP_ROWS = 1_000_000
#: Ranges that rows are dealt in, at most, where that leaves ranges of no more than GROUP_ROWS rows.
RANGES = 500


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "seq", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Row numbers in each group, from 1, by ``order`` and, of equal ones, by a hash of the row, so that the
    numbers are the same in any run and on any path. ``order`` may hold anything that can be sorted; nulls go where
    its columns say.

    If no group has more than ``group_rows`` rows, they come from a window. Else all rows are dealt in ranges
    of group, order and hash, of about ``group_rows`` rows each, and sorted there: a row's number is its place,
    plus the rows of the ranges before, less those before its group. More than RANGES ranges are made only beyond GROUP_ROWS
    rows each, as each range's samples and status go to the driver. Only rows equal in all columns can't be told
    apart, and stay in one range; the counts of ranges come to one task."""
    hashed = [F.col(f"`{c}`") for c in df.columns if _hashable(df.schema[c].dataType)]
    total = [*order, F.xxhash64(*hashed)] if hashed else [*order]
    sizes = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    if (sizes["most"] or 0) <= group_rows:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*total)).cast("long"))
    keys = [F.col(c).asc_nulls_first() for c in by]
    ranges = max(2, min(sizes["all"] // group_rows + 1, max(RANGES, sizes["all"] // GROUP_ROWS + 1)))
    dealt = df.repartitionByRange(ranges, *keys, *total).sortWithinPartitions(*keys, *total)
    placed = written(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered")  # the number of the range, and the place in it
    placed = placed.withColumns({"_range": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = placed.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", before.alias("_before"))
    placed = placed.join(F.broadcast(ranges), "_range").withColumn("_at", F.col("_at") + F.col("_before"))  # a row for each range
    if not by:
        return placed.select(*df.columns, (F.col("_at") + 1).alias(name))
    own = [f"_by{i}" for i in range(len(by))]
    starts = placed.groupBy(*[F.col(c).alias(k) for c, k in zip(by, own, strict=True)]).agg(F.min("_at").alias("_start"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, own, strict=True)])
    return placed.join(starts, same).select(*df.columns, (F.col("_at") - F.col("_start") + 1).alias(name))


def part(label: Column, known: Sequence[str], other: str) -> Column:
    """The part of ``route`` that a row goes to: where parts are only counted or grouped, one pass does it."""
    return F.when(label.isin(*known), label).otherwise(other)


def route(df: DataFrame, label: str, known: Sequence[str], other: str) -> dict[str, DataFrame]:
    """A part for each label; unknown and null ones go to ``other``. Each part that is used computes ``df`` anew."""
    name = part(F.col(label), known, other)
    return {k: df.filter(name == k) for k in dict.fromkeys([*known, other])}


def with_empty(counts: DataFrame, label: str, known: Sequence[str]) -> DataFrame:
    """A row for each of the ``known`` labels, with the count 0 and a status where there is none."""
    all_labels = counts.sparkSession.createDataFrame([(k,) for k in known], f"{label} string")
    joined = all_labels.join(counts, label, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    return joined.withColumn("status", F.when(F.col("n") == 0, "no_match").otherwise("ok"))


def without_status(df: DataFrame, status: str = "no_match", column: str = "status") -> DataFrame:
    """Without the rows that only stand for an empty part; a null status is a row like any other."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(status)))


def required(spark: SparkSession, *paths: str) -> None:
    """An error that names the inputs that can't be read, before anything starts."""
    missing = []
    for path in paths:
        try:
            spark.read.format("binaryFile").load(path).limit(0).count()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError(f"missing inputs: {', '.join(missing)}")


def enabled(df: DataFrame, flag: bool, step: Callable[[DataFrame], DataFrame], empty: Mapping[str, str] | None = None) -> DataFrame:
    """``step(df)`` if the flag is on; else ``df`` with the columns of ``empty`` (name: type) as nulls."""
    if flag:
        return step(df)
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in (empty or {}).items()})
