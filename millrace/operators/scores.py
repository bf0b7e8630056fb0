"""Rates, weighted keyword scores, bands and orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_of

#: Name, lower bound (included) of each band below the top one; exactly 0 and 1 have their own.
BANDS = (("match_80_99", 0.8), ("match_60_79", 0.6), ("match_40_59", 0.4), ("match_20_39", 0.2), ("match_1_19", 0.0))
BAND_NAMES = ("match_100", *(n for n, _ in BANDS), "match_0")


def match_rate(skills: Column) -> Column:
    """Share of the structs whose ``match`` is true; 0 for none."""
    n = F.size(skills)
    hits = F.size(F.filter(skills, lambda s: F.coalesce(s["match"], F.lit(False))))
    return F.when(skills.isNull() | (n == 0), 0.0).otherwise(hits / n)


def rate(flags: Column) -> Column:
    """Share of true values of an array of booleans; 0 for none."""
    return F.when(flags.isNull() | (F.size(flags) == 0), 0.0).otherwise(F.size(F.filter(flags, lambda f: F.coalesce(f, F.lit(False)))) / F.size(flags))


def band(rate: Column) -> Column:
    tests = [F.when(rate >= 1.0, "match_100"), *[F.when((rate >= low) if low else (rate > 0.0), n) for n, low in BANDS]]
    return F.coalesce(*tests, F.lit("match_0"))


def keyword_score(text: Column, weights: Mapping[str, float], caps: Mapping[str, int] | None = None) -> Column:
    """Sum of weight times count (up to a cap) of each keyword."""
    caps = caps or {}
    count = lambda w: F.least(count_of(text, w), F.lit(caps[w])) if w in caps else count_of(text, w)
    return reduce(lambda a, b: a + b, [count(w) * F.lit(float(x)) for w, x in weights.items()], F.lit(0.0))


def tiers(text: Column, patterns: Sequence[tuple[float, str]]) -> Column:
    """The value of the first pattern that is found; 0 for none."""
    return F.coalesce(*[F.when(text.rlike(p), F.lit(v)) for v, p in patterns], F.lit(0.0))


def distinct_labels(text: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [text.rlike(p).cast("int") for p in patterns])


def worst_status(counts: Mapping[str, Column]) -> Column:
    """The first of (not_confirmed, human_review) that has a count, else confirmed."""
    return F.when(counts["not_confirmed"] > 0, "not_confirmed").when(counts["human_review"] > 0, "human_review").otherwise("confirmed")


def distribution(df: DataFrame, by: str) -> DataFrame:
    """Counts and shares of each value."""
    counted = df.groupBy(by).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("_total"))
    return counted.crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.col("_total")).drop("_total")


def classify(scores: Mapping[str, Column], margin: float = 0.5, strong_margin: float = 0.2, least: float = 0.2, strong_least: float = 0.05, strong: Mapping[str, Column] | None = None) -> Column:
    """(label, confidence): the side that leads by the margin with enough confidence (or by twice
    the margin); a side with ``strong`` evidence needs less; "ambiguous" otherwise, and "unknown"
    if both scores are 0. The first side is tested first."""
    (a, x), (b, y) = scores.items()
    strong = strong or {}
    sure = F.abs(x - y) / F.greatest(F.lit(1.0), x + y)

    def leads(side: str, own: Column, other: Column) -> Column:
        is_strong = strong.get(side, F.lit(False))
        need, low = F.when(is_strong, strong_margin).otherwise(margin), F.when(is_strong, strong_least).otherwise(least)
        return (own - other >= need) & ((sure >= low) | (own - other >= 2 * need))

    label = F.when(x + y <= 0, "unknown").when(leads(a, x, y), a).when(leads(b, y, x), b).otherwise("ambiguous")
    return F.struct(label.alias("label"), sure.alias("confidence"))


def total(required: Column, optional: Column) -> Column:
    """The sum of both rates (0 to 2); a missing one counts as 0."""
    return F.coalesce(required, F.lit(0.0)) + F.coalesce(optional, F.lit(0.0))


def frequencies(df: DataFrame, items: str) -> DataFrame:
    """How many rows have each item of an array, as item and n; an item counts once a row."""
    return df.select(F.explode(F.array_distinct(items)).alias("item")).groupBy("item").agg(F.count("*").alias("n"))


def averages(df: DataFrame, values: Mapping[str, Column], success: Column, least: float = 0.9) -> DataFrame:
    """One row: the mean of each value, the share of rows with ``success``, and whether it is below ``least``."""
    means = [F.avg(v).alias(k) for k, v in values.items()]
    share = F.avg(F.coalesce(success, F.lit(False)).cast("int"))
    return df.agg(*means, share.alias("success_rate"), (share < least).alias("warn"))
