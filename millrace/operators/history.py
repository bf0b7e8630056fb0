"""What was judged before: semi and anti joins with a history, and restoring by ordinal."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seen_and_new(df: DataFrame, history: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    known = history.select(*keys).distinct()
    return df.join(known, list(keys), "left_semi"), df.join(known, list(keys), "left_anti")


def ordinal_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_order: Sequence[Column], right_order: Sequence[Column], how: str = "inner") -> DataFrame:
    """The k-th row of a key with the k-th row of the same key: each row is used once at most. The rows
    of one key are numbered in one task, which sorts and spills them; it is meant for keys of a pair or
    a mail, of which there are few rows, and not for keys that a notable share of all rows has."""
    rank = lambda df, order: df.withColumn("ordinal", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return rank(left, left_order).join(rank(right, right_order), [*keys, "ordinal"], how)


def restore(wanted: DataFrame, cache: DataFrame, exact: Sequence[str], loose: Sequence[str], order: str, cache_order: str) -> DataFrame:
    """``wanted`` with the tier that found a cached row ("exact", "loose", null) and that row's
    ``cache_order``. Rows are matched by ordinal on the exact keys first; what is left on both
    sides then on the loose keys; no cached row is used twice."""
    own = list(dict.fromkeys([*exact, *loose]))
    a, b = wanted.select(*own, order), cache.select(*own, cache_order)
    if order == cache_order:
        raise ValueError("order columns need different names")
    first = ordinal_join(a.drop(*[c for c in own if c not in exact]), b.drop(*[c for c in own if c not in exact]), exact, [F.col(order)], [F.col(cache_order)])
    first = first.select(order, cache_order, F.lit("exact").alias("tier"))
    a2, b2 = a.join(first.select(order), order, "left_anti"), b.join(first.select(cache_order), cache_order, "left_anti")
    second = ordinal_join(a2.select(*loose, order), b2.select(*loose, cache_order), loose, [F.col(order)], [F.col(cache_order)])
    found = first.unionByName(second.select(order, cache_order, F.lit("loose").alias("tier")))
    return wanted.join(found, order, "left")


def merge(history: DataFrame, restored: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> tuple[DataFrame, DataFrame]:
    """(merged, errors): for each history row the restored result, else the new one; history rows
    without and results without history are errors, with a code."""
    ranked = lambda df, name: df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(name)))
    have = restored.withColumn("_source", F.lit(0)).unionByName(new.withColumn("_source", F.lit(1)))
    have = have.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("_source", order)))
    wanted = ranked(history.select(*keys, F.col(order).alias("_order")), "_order")
    joined = wanted.join(have, [*keys, "_k"], "full")
    code = F.when(F.col("_source").isNull(), "merge_source_not_found").when(F.col("_order").isNull() & (F.col("_source") == 0), "unused_restored_result").when(F.col("_order").isNull(), "unused_new_ai_result")
    marked = joined.withColumn("error", code)
    return marked.filter("error IS NULL").drop("_k", "_order", "_source", "error"), marked.filter("error IS NOT NULL").select(*keys, "error")


class RunState:
    """History and cache of runs as a log: parts of tables below ``path``/parts, and ``path``/log with a row for each
    part that counts (run, tag, name, base, part). A table is its last base and the parts behind it.

    ``commit`` replaces tables by new bases, as a batch run does; ``append`` adds parts of the size of what is new, as
    micro-batches do, and every ``compact_after`` parts a base is written of them. Parts are written first, under names of
    their own, and all rows of a run go to the log in one write: without it, what a run has left
    counts for nothing, so history and cache advance together or not at all, and a run can be repeated."""

    LOG = "run long, tag long, name string, base boolean, part string"

    def __init__(self, spark, path: str, compact_after: int = 50):
        self.spark, self.path, self.compact_after = spark, path.rstrip("/"), compact_after

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.LOG).parquet(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _last(self, column: str) -> int | None:
        log = self._log()
        return None if log is None else log.agg(F.max(column)).first()[0]

    def latest(self) -> int | None:
        return self._last("run")

    def latest_tag(self) -> int | None:
        """The largest tag (such as a micro-batch's number) that a run was committed with."""
        return self._last("tag")

    def parts(self, name: str) -> list[str]:
        """Names of the parts that make up a table, its base first."""
        log = self._log()
        if log is None:
            return []
        base = log.filter((F.col("name") == name) & F.col("base")).agg(F.max("run")).first()[0]
        found = log.filter((F.col("name") == name) & (F.col("run") >= F.lit(base if base is not None else 0)))
        return [r["part"] for r in found.orderBy("run").select("part").collect()]

    def read(self, name: str) -> DataFrame | None:
        found = self.parts(name)
        return self.spark.read.parquet(*[f"{self.path}/parts/{x}" for x in found]) if found else None

    def _write(self, tables: Mapping[str, DataFrame], base: bool, tag: int | None) -> int:
        run = (self.latest() or 0) + 1
        rows = []
        for name, table in tables.items():
            part = f"{name}-{run}-{uuid.uuid4().hex}"
            table.write.parquet(f"{self.path}/parts/{part}")
            rows.append((run, tag, name, base, part))
        self.spark.createDataFrame(rows, self.LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")  # one file: all or nothing
        return run

    def commit(self, history: DataFrame, cache: DataFrame, errors: DataFrame, tag: int | None = None) -> int:
        """History and cache of a run as new bases. With errors the cache stays as it was."""
        keep = bool(self.parts("cache")) and not errors.isEmpty()
        return self._write({"history": history} if keep else {"history": history, "cache": cache}, True, tag)

    def append(self, history: DataFrame, cache: DataFrame, tag: int | None = None) -> int | None:
        """New rows of both, in one run. A tag that isn't above the last one was committed already: nothing is done."""
        done = self.latest_tag() if tag is not None else None
        if done is not None and tag <= done:
            return None
        run = self._write({"history": history, "cache": cache}, False, tag)
        if len(self.parts("history")) > self.compact_after:
            run = self._write({name: self.read(name) for name in ("history", "cache")}, True, tag)
        return run


def rechecked(pairs: DataFrame, confirmed: DataFrame, review: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``pairs`` that a recheck confirmed or left to a human, with recheck_status; of several rows of a
    pair the later one counts, and ``review`` is later than ``confirmed``."""
    rows = confirmed.select(*keys, F.lit(0).alias("_file"), F.col(order).alias("_at"), F.lit("confirmed").alias("recheck_status"))
    rows = rows.unionByName(review.select(*keys, F.lit(1).alias("_file"), F.col(order).alias("_at"), F.lit("human_review").alias("recheck_status")))
    last = rows.groupBy(*keys).agg(F.max_by("recheck_status", F.struct("_file", "_at")).alias("recheck_status"))
    return pairs.join(last, list(keys))
