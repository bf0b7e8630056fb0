"""Column functions on numbers, dates, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def midpoint(low: Column, high: Column) -> Column:
    return F.floor((low + high) / 2).cast("long")


def bounded(value: Column, low: float, high: float) -> Column:
    """Null outside of the bounds."""
    return F.when(value.between(low, high), value)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def floor_to(value: Column, unit: int) -> Column:
    return (F.floor(value / unit) * unit).cast("long")


def confidence(a: Column, b: Column) -> Column:
    """How far apart two scores are, by their sum (1 at least)."""
    return F.abs(a - b) / F.greatest(F.lit(1.0), a + b)


def run_date(text: Column) -> Column:
    """A date from eight digits; null for anything else."""
    return F.when(text.rlike("^[0-9]{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))


#: Chinese numerals of one character, and the digits they stand for.
NUMERALS, DIGITS = "〇一二三四五六七八九", "0123456789"


def digit(text: Column) -> Column:
    """A number written in digits of any of the usual kinds; null for anything else."""
    return F.translate(F.translate(text, NUMERALS, DIGITS), "0123456789", DIGITS).try_cast("int")


def price_plan(demand: Column, supply: Column, *, share: float = 0.9, unit: int = 10_000, least: int = 120_000) -> Column:
    """(gap, target, for_demand, for_supply, low): what to keep of the gap between two prices:
    ``share`` of it in whole ``unit``s, ``least`` at least, the gap at most; without a gap, nothing."""
    gap = demand - supply
    target = F.least(F.greatest(floor_to(gap * share, unit), F.lit(least)), gap)
    ok = gap > 0
    value = lambda c: F.when(ok, c)
    return F.struct(gap.alias("gap"), value(target).alias("target"), value(supply + target).alias("for_demand"), value(demand - target).alias("for_supply"), (ok & (gap < least)).alias("low"))


def marks(skill: Column, text: Column) -> Column:
    """A skill is in a text, or one of its tokens of two characters and more is."""
    low = F.lower(text)
    tokens = F.filter(F.split(F.lower(skill), "[\\s/・,、()]+"), lambda t: F.length(t) >= 2)
    return F.contains(low, F.lower(skill)) | F.exists(tokens, lambda t: F.contains(low, t))
