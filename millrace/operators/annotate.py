"""Dictionary annotation, phases and label values."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import bounded


ASCII_WORD = re.compile("[A-Za-z0-9]")


def folded(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def bordered(text: str, start: int, end: int) -> bool:
    """No letter, digit or hyphen (in front, no dot either) of ASCII next to a term."""
    before, after = text[start - 1 : start], text[end : end + 1]
    return not (before and (ASCII_WORD.match(before) or before in ".-")) and not (after and (ASCII_WORD.match(after) or after == "-"))


class Terms:
    """All terms of a dictionary in one automaton, so that a text is read once whatever their number.
    ASCII terms need a border on either side; others don't."""

    def __init__(self, dictionary: Mapping[str, Sequence[str]]):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        by: dict[str, list[tuple[int, str, str]]] = {}
        for order, (category, terms) in enumerate(dictionary.items()):
            for term in dict.fromkeys(t for t in terms if t):
                by.setdefault(folded(term), []).append((order, category, term))
        for low, found in by.items():
            self.machine.add_word(low, found)
        self.machine.make_automaton()
        self.size = len(by)

    def annotate(self, text: str) -> list[tuple[int, str, str]]:
        """(position, category, term) in text order. Categories take their spans in order, in each the
        longest terms first; a span is taken once."""
        hits = []
        for last, found in self.machine.iter(folded(text)) if self.size else ():
            for order, category, term in found:
                start = last + 1 - len(term)
                if not term.isascii() or bordered(text, start, last + 1):
                    hits.append((order, -len(term), term, start, category))
        taken, out = bytearray(len(text)), []
        for _, size, term, start, category in sorted(hits):
            if not any(taken[start : start - size]):
                taken[start : start - size] = b"\1" * -size
                out.append((start, category, term))
        return sorted(out)


def annotated(df: DataFrame, dictionary: Mapping[str, Sequence[str]], *, text: str = "text", aliases: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with terms (distinct, in text order), by_category (a map) and raw (the text around
    the span from the first to the last, 200 characters at most). A null text has no terms."""
    aliases = dict(aliases or {})
    plain = {k: list(v) for k, v in dictionary.items()}

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Terms(plain)
        for series in batches:
            out = []
            for value in series:
                found = known.annotate(value) if isinstance(value, str) else []
                named = [(c, aliases.get(t, t)) for _, c, t in found]
                terms = list(dict.fromkeys(t for _, t in named))
                by = {c: list(dict.fromkeys(t for k, t in named if k == c)) for c in dict.fromkeys(c for c, _ in named)}
                raw = value[max(0, found[0][0] - 20) : found[-1][0] + 60][:200] if found else None
                out.append((terms, by, raw))
            yield pd.DataFrame(out, columns=["terms", "by_category", "raw"])

    scan = F.pandas_udf(run, "terms array<string>, by_category map<string,array<string>>, raw string")
    return bounded(df).withColumn("_a", scan(F.col(text))).select(*df.columns, "_a.*")


def first_of_groups(text: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Names of the groups with a term in the text, in the order of their first terms' places. Each
    group counts by its longest term that occurs. JVM only; for packs of some dozens of groups."""
    place = lambda terms: F.coalesce(*[F.when(F.instr(text, t) > 0, F.instr(text, t)) for t in sorted(terms, key=lambda t: (-len(t), t))], F.lit(None).cast("int"))
    hits = F.array(*[F.struct(place(v).alias("at"), F.lit(k).alias("name")) for k, v in groups.items()])
    return F.transform(F.array_sort(F.filter(hits, lambda h: h["at"].isNotNull())), lambda h: h["name"])


def primary(skills: Column, required_text: Column) -> Column:
    """Skills that occur in the required texts; all of them if there are none."""
    low = F.lower(F.coalesce(required_text, F.lit("")))
    return F.when(low == "", skills).otherwise(F.filter(skills, lambda s: F.contains(low, F.lower(s))))


def label_value(text: Column, label: str, header: str = "^\\s*[【\\[■◆●]") -> Column:
    """What follows a label: behind its colon, else on the next line that isn't empty or a header."""
    pattern = f"(?m)^[^\\n]*?(?:{label})[ \\t\\u3000】\\]]*[::]?[ \\t\\u3000]*([^\\n]*)(?:\\n\\s*([^\\n]+))?"
    inline, below = F.trim(F.regexp_extract(text, pattern, 1)), F.trim(F.regexp_extract(text, pattern, 2))
    return F.when(inline != "", inline).when((below != "") & ~below.rlike(header), below)
