"""Places in mails to regions, by a dictionary of regions and their place names.

All names stand in one automaton, so a text is read once whatever their number. Where a place may stand
is a list of sources in the order in which they are believed; the first with a name gives the region."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .sections import STRONG, WEAK, Signature

WORK_LABEL = "勤務地|作業場所|就業場所|勤務場所|場所|最寄"
HOME_LABEL = "最寄|住所|居住地?|在住|お住まい"
NAME_LABEL = "氏名|名前"
NEAR_HOME = "駅|在住|住まい|通勤"
REMOTE = "リモート|テレワーク|在宅"
OVERSEAS = "海外(?:在住)?|オフショア"
#: A line of basic facts: an age and a sex, or three fields and an age.
FACTS = re.compile(r"[0-9]{2}\s*[歳才].*(?:男|女)|(?:男|女).*[0-9]{2}\s*[歳才]|[0-9]{2}\s*[歳才][^/|]*[/|][^/|]+[/|]")
#: A name with a place behind it, which is no address.
AT = re.compile(r"(?<![\w.])[A-Za-z][A-Za-z. ]{0,8}@\s*([^\s@()/,、.]+)(?![\w.]*\.[a-z])")
RAILWAY = re.compile(r"[^\s:、,/()]+?線")
BRACKETS = re.compile(r"\(([^()]*)\)")
#: Letters that join with a name to another one, so that it isn't met there.
JOINED = re.compile("[一-鿿ァ-ヴー々]")
PLACE = "region string, place string, source string"


class Names:
    """Place names of all regions in one automaton."""

    def __init__(self, regions: Mapping[str, Sequence[str]]):
        import ahocorasick

        self.machine, self.size = ahocorasick.Automaton(), 0
        for region, names in regions.items():
            for name in names:
                if name and name not in self.machine:
                    self.machine.add_word(name, (name, region))
                    self.size += 1
        self.machine.make_automaton()

    def first(self, text: str, bounded: bool = False) -> tuple[str, str] | None:
        """(region, name) of the leftmost name, of several there the longest; ``bounded``: not behind a letter
        that joins with it, nor inside of a longer name that is."""
        best = None
        for end, (name, region) in self.machine.iter(text) if self.size else ():
            start = end + 1 - len(name)
            if bounded and start and JOINED.match(text[start - 1]):
                continue
            if best is None or (start, -len(name)) < best[:2]:
                best = (start, -len(name), region, name)
        return best and (best[2], best[3])


Source = tuple[str, Callable[[str], Iterator[str]]]


def _labelled(label: str, behind: bool) -> Callable[[str], Iterator[str]]:
    """What follows a label on its line, and with ``behind`` the next line, too, or if nothing follows."""
    pattern = re.compile(f"(?:{label})[^:\\s】\\])]{{0,6}}[\\s】\\])]*:?(.*)")

    def found(text: str) -> Iterator[str]:
        lines = text.split("\n")
        for i, line in enumerate(lines):
            hit = pattern.search(line)
            if hit:
                yield hit[1]
                if i + 1 < len(lines) and (behind or not hit[1].strip()):
                    yield lines[i + 1]

    return found


def _around(label: str) -> Callable[[str], Iterator[str]]:
    pattern = re.compile(label)

    def found(text: str) -> Iterator[str]:
        lines = text.split("\n")
        for i, line in enumerate(lines):
            if pattern.search(line):
                yield from lines[max(0, i - 1) : i + 2]

    return found


def _lines(test: re.Pattern) -> Callable[[str], Iterator[str]]:
    return lambda text: (x for x in text.split("\n") if test.search(x))


HOME_SOURCES: tuple[Source, ...] = (
    ("facts", _lines(FACTS)), ("at", lambda text: (m[1] for m in AT.finditer(text))), ("name", _labelled(NAME_LABEL, False)),
    ("label", _labelled(HOME_LABEL, False)), ("context", _around(f"{NEAR_HOME}|{HOME_LABEL}")),
)


def home_place(names: Names, text: str) -> tuple[str, str | None, str]:
    """(region, place, source) of a supply. Railway lines don't count, brackets only after what stands outside of them."""
    for source, candidates in HOME_SOURCES:
        for part in candidates(text):
            plain = RAILWAY.sub(" ", part)
            for piece in (BRACKETS.sub(" ", plain), *BRACKETS.findall(plain)):
                hit = names.first(piece, bounded=True)
                if hit:
                    return *hit, source
    return ("overseas" if re.search(OVERSEAS, text) else "unknown"), None, "default"


WORK_SOURCES: tuple[Source, ...] = (("label", _labelled(WORK_LABEL, True)),)
FOOTER = re.compile(f"{STRONG}|{WEAK}")


def work_place(names: Names, text: str, signature: Signature = Signature()) -> tuple[str | None, str | None, str]:
    """The same of a demand, without its signature: from labelled lines, part by part, else from any line
    that isn't of a footer, else "remote"; null for none."""
    body = signature.trim(text)
    for source, candidates in WORK_SOURCES:
        for part in candidates(body):
            for piece in re.split("[、,/・|\\s]+", part):
                hit = names.first(piece)
                if hit:
                    return *hit, source
    hit = names.first("\n".join(x for x in body.split("\n") if not FOOTER.search(x)))
    if hit:
        return *hit, "body"
    return ("remote", None, "remote") if re.search(REMOTE, text) else (None, None, "default")


def _scanned(find: Callable[[Names, str], tuple], regions: Mapping[str, Sequence[str]], text: Column) -> Column:
    plain = {k: list(v) for k, v in regions.items()}

    @F.pandas_udf(PLACE)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = Names(plain)
        for texts in batches:
            yield pd.DataFrame([find(names, x if isinstance(x, str) else "") for x in texts], columns=["region", "place", "source"])

    return run(text)


def work_location(text: Column, regions: Mapping[str, Sequence[str]], case_header: str = "案件") -> Column:
    """(region, place, source) of a demand."""
    signature = Signature(case_header)
    return _scanned(lambda names, x: work_place(names, x, signature), regions, text)


def home_location(text: Column, regions: Mapping[str, Sequence[str]]) -> Column:
    """(region, place, source) of a supply."""
    return _scanned(home_place, regions, text)


def work_region(text: Column, regions: Mapping[str, Sequence[str]], case_header: str = "案件") -> Column:
    return work_location(text, regions, case_header)["region"]


def home_region(text: Column, regions: Mapping[str, Sequence[str]]) -> Column:
    return home_location(text, regions)["region"]
