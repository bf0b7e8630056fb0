"""Rule packs: ordered tables of patterns that turn a text into a value, its source and the raw match.

Packs are data. ``first_match`` compiles one to a CASE expression; a scope narrows a rule to lines
with a label or to windows around an anchor."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``value``: a constant, or the number of the pattern's group (of two groups, with ``other``, the
    larger one) times ``factor`` plus ``plus``. A number outside of ``low`` to ``high`` is no match."""

    pattern: str
    value: str | int | float | bool | None = None
    group: int = 0
    factor: int = 1
    plus: int = 0
    other: int = 0
    low: int | None = None
    high: int | None = None


def let(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


def lines_with(text: Column, label: str, following: int = 0) -> Column:
    """Lines that match ``label`` (with as many behind each), joined by newlines."""
    near = lambda lines, i: F.exists(F.sequence(F.greatest(i - following, F.lit(0)), i), lambda j: F.get(lines, j).rlike(label))
    return let(F.split(text, "\n", -1), lambda lines: F.array_join(F.filter(lines, lambda _, i: near(lines, i)), "\n"))


def windows_of(text: Column, anchor: str, before: int, after: int) -> Column:
    """What stands around the matches of ``anchor``, as an array; a window goes on behind the one before."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{0,{before}}}(?:{anchor}).{{0,{after}}}"), F.lit(0))


def windows(text: Column, anchor: str, before: int, after: int) -> Column:
    """The same, joined by newlines."""
    return F.array_join(windows_of(text, anchor, before, after), "\n")


def _hit(text: Column, rule: Rule, kind: str) -> Column:
    """(value, source, raw) where the rule matches, else null."""
    number = lambda g: F.regexp_extract(text, rule.pattern, g).try_cast("long")
    ok = text.rlike(rule.pattern)
    if rule.group:
        value = (F.greatest(number(rule.group), number(rule.other)) if rule.other else number(rule.group)) * rule.factor + rule.plus
        if rule.low is not None or rule.high is not None:
            ok = ok & value.between(rule.low if rule.low is not None else -(1 << 62), rule.high if rule.high is not None else 1 << 62)
    else:
        value = F.lit(rule.value)
    return F.when(ok, F.struct(value.cast(kind).alias("value"), F.lit("extracted").alias("source"), F.regexp_extract(text, rule.pattern, 0).alias("raw")))


def _none(default, kind: str) -> Column:
    return F.struct(F.lit(default).cast(kind).alias("value"), F.lit("default").alias("source"), F.lit(None).cast("string").alias("raw"))


def first_match(text: Column, rules: Sequence[Rule], default: str | int | float | bool | None = None, kind: str = "string") -> Column:
    """(value, source, raw) of the first rule that is found; source is "extracted" or "default"."""
    return F.coalesce(*[_hit(text, r, kind) for r in rules], _none(default, kind))


def first_in(parts: Column, rules: Sequence[Rule], default: str | int | float | bool | None = None, kind: str = "string") -> Column:
    """The same for an array of texts: that of the first text in which any rule is found."""
    return F.coalesce(found_in(parts, rules, kind), _none(default, kind))


def found_in(parts: Column, rules: Sequence[Rule], kind: str = "string") -> Column:
    """The same, null if none is found."""
    hits = F.filter(F.transform(parts, lambda x: F.coalesce(*[_hit(x, r, kind) for r in rules])), lambda h: h.isNotNull())
    return F.get(hits, F.lit(0))


def range_of(text: Column, pattern: str, low: int = 1, high: int = 2, factor: int = 1) -> Column:
    """(min, max) from two groups; null if there is no match or a number is missing."""
    number = lambda g: F.regexp_extract(text, pattern, g).try_cast("long") * factor
    return F.when(text.rlike(pattern), F.struct(number(low).alias("min"), number(high).alias("max")))


def highest_level(text: Column, label: str, levels: Sequence[tuple[int, str]]) -> Column:
    """The largest level of the lines with the label, else of the whole text; null for none."""
    level = lambda t: F.coalesce(*[F.when(t.rlike(p), F.lit(n)) for n, p in levels], F.lit(None).cast("int"))
    marked = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(label))
    return F.coalesce(F.array_max(F.transform(marked, level)), level(text))
