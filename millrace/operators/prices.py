"""Prices of a month in yen, as rules over the quantities of a text (``amounts.spans``).

A quantity is money of one of the kinds of ``KINDS``, in the order in which they are believed; the first of the best
kind counts. Hours and days are multiplied up to a month."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import amounts
from .rules import let, windows_of

#: Hours and days of a month, yen of one "man", the price of "by skill", and bounds in yen.
HOURS, DAYS, MAN, BY_SKILL = 160, 20, 10_000, 1_000_000
RANGE, SINGLE = (100_000, 5_000_000), (200_000, 3_000_000)

LABEL = "単\\s*[価金]|金\\s*額|報\\s*酬|予\\s*算|月\\s*額|[時日]\\s*給"
SKILL = "スキル\\s*(?:見合|次第|に応|相応)|経験\\s*(?:見合|次第|に応)|(?:応|要)\\s*相談|ご?相談(?:の上|ください)"
#: A line that starts a field of its own.
FIELD = "^\\s*(?:[【\\[■□◆◇●○▼*]|[^\\s::、。]{1,12}\\s*:)"


@dataclass(frozen=True)
class Kind:
    """``name`` of the reason, by what the quantity is counted (None: anything), its unit, a factor to yen a
    month, and whether the bounds hold."""

    name: str
    period: str | None
    unit: str
    factor: int
    bounded: bool = True


KINDS = (
    Kind("month-man", "month", "^万", MAN), Kind("month-yen", "month", "^円$", 1),
    Kind("day-man", "day", "^万", MAN * DAYS, False), Kind("day-yen", "day", "^円?$", DAYS, False),
    Kind("hour-man", "hour", "^万", MAN * HOURS, False), Kind("hour-yen", "hour", "^円?$", HOURS, False),
    Kind("man", None, "^万", MAN), Kind("yen", None, "^円$", 1),
)
#: A line that is about a price, but whose bare numbers are of something else.
OTHER = "精\\s*算|年\\s*齢|時\\s*間|[hH]"


def _money(span: Column, line: Column, bare: bool) -> Column:
    """(rank, reason, low, high, open) of a quantity that is a price, else null."""
    period = amounts.period(span)
    two = span["second"].isNotNull()

    def value(kind: Kind) -> Column:
        low, high = span["first"] * kind.factor, F.coalesce(span["second"], span["first"]) * kind.factor
        a, b = F.least(low, high).cast("long"), F.greatest(low, high).cast("long")
        open_ = (span["mark"] != "") | (span["before"] != "")
        least, most = F.when(two | open_, RANGE[0]).otherwise(SINGLE[0]), F.when(two | open_, RANGE[1]).otherwise(SINGLE[1])
        ok = amounts.is_unit(span, kind.unit) & ((a >= least) & (b <= most) if kind.bounded else F.lit(True))
        if kind.period:
            ok = ok & (period == kind.period)
        elif kind.name == "yen":
            ok = ok & (span["grouped"] | (a >= RANGE[0]))
        return F.when(ok & (period.isNull() if not kind.period else F.lit(True)), F.struct(F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind.name).alias("reason"), a.alias("low"), b.alias("high")))

    found = [value(k) for k in KINDS]
    if bare:  # "40-50" behind the label of a price
        digits = lambda c: c.between(10, 999) & (c == F.floor(c))
        unmarked = (span["unit"] == "") & (span["second_unit"] == "") & period.isNull()
        ok = two & unmarked & digits(span["first"]) & digits(span["second"]) & line.rlike(LABEL) & ~line.rlike(OTHER)
        low, high = F.least(span["first"], span["second"]), F.greatest(span["first"], span["second"])
        found.append(F.when(ok, F.struct(F.lit(len(KINDS)).alias("rank"), F.lit("bare").alias("reason"), (low * MAN).cast("long").alias("low"), (high * MAN).cast("long").alias("high"))))
    return F.coalesce(*found)


def _answer(value, low, high, reason: Column, raw, source: str = "extracted") -> Column:
    null = F.lit(None)
    return F.struct(
        *[(null if x is None else x).cast("long").alias(n) for n, x in (("value", value), ("min", low), ("max", high))],
        reason.alias("reason"), (null if raw is None else raw).cast("string").alias("raw"), F.lit(source).alias("source"),
    )


def priced(text: Column, prefix: str = "", by_skill: bool = True, bare: bool = True) -> Column:
    """(value, min, max, reason, raw, source) of the best quantity of a text, else of "by skill", else null."""

    def best(found: Column) -> Column:
        read = lambda s, i: let(_money(s, text, bare), lambda m: F.when(m.isNotNull(), F.struct(m["rank"].alias("rank"), i.alias("i"), m.alias("m"), s.alias("s"))))
        return F.array_min(F.filter(F.transform(found, read), lambda x: x.isNotNull()))

    def told(x: Column) -> Column:
        two, m, s = x["s"]["second"].isNotNull(), x["m"], x["s"]
        low = F.when(two | (s["mark"] != ""), m["low"])
        high = F.when(two | ((s["before"] != "") & (s["mark"] == "")), m["high"])
        return F.when(x.isNotNull(), _answer(F.floor((m["low"] + m["high"]) / 2), low, high, F.concat(F.lit(prefix), m["reason"]), s["raw"]))

    number = let(let(amounts.spans(text), best), told)
    if not by_skill:
        return number
    return F.coalesce(number, F.when(text.rlike(SKILL), _answer(F.lit(BY_SKILL), None, None, F.lit(prefix + "skill"), F.regexp_extract(text, SKILL, 0))))


def segments(text: Column) -> Column:
    """Lines with the label of a price; a line without a value takes the next one that isn't blank with it,
    unless that is a field of its own. A text of up to 200 characters without such a line is its own segment."""
    says = lambda line: line.rlike(f"[0-9]|{SKILL}")

    def one(lines: Column, line: Column, i: Column) -> Column:
        below = F.get(F.filter(F.slice(lines, i + 2, F.greatest(F.size(lines) - i - 1, F.lit(0))), lambda x: x != ""), F.lit(0))
        joined = let(below, lambda b: F.when(says(b) & ~b.rlike(FIELD), F.concat(line, F.lit("\n"), b)).otherwise(line))
        return F.when(line.rlike(LABEL), F.when(says(line), line).otherwise(F.coalesce(joined, line)))

    found = lambda lines: F.array_distinct(F.filter(F.transform(lines, lambda line, i: one(lines, line, i)), lambda x: x.isNotNull()))
    own = let(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), found)
    return let(own, lambda x: F.when(F.size(x) > 0, x).when(F.length(text) <= 200, F.array(text)).otherwise(F.array().cast("array<string>")))


def _first(parts: Column, prefix: str = "", **how) -> Column:
    """That of the first part that has any."""
    return F.get(F.filter(F.transform(parts, lambda x: priced(x, prefix, **how)), lambda h: h.isNotNull()), F.lit(0))


def project_price(text: Column, subject: Column | None = None) -> Column:
    """(value, min, max, reason, raw, source) of a demand; a price of the subject has "subject-" before its reason."""
    options = [let(segments(text), lambda x: _first(x))]
    if subject is not None:
        options.append(let(segments(subject), lambda x: _first(x, "subject-")))
    return F.coalesce(*options, _answer(None, None, None, F.lit("none"), None, "default"))


def resource_price(text: Column, subject: Column | None = None) -> Column:
    """The same of a supply, from windows behind the labels; "by skill" counts only if no window has a number."""
    near = windows_of(text, LABEL, 5, 150)
    options = [let(near, lambda x: F.coalesce(_first(x, by_skill=False), _first(x)))]
    if subject is not None:
        options.append(priced(F.coalesce(subject, F.lit("")), "subject-"))
    return F.coalesce(*options, _answer(None, None, None, F.lit("none"), None, "default"))
