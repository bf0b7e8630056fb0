"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds the words of all items of a block of the benchmark. Words of a document are
streamed through it, with the length of the longest suffix that occurs in an item. A run of words
can match only if each of its pairs of neighbours occurs in an item, so other words, nearly all,
are skipped in numpy before. A match of ``window`` words (or of a whole shorter item) marks its
words; maximal marked runs are the spans.

The benchmark's words are counted first: a block has about ``block_words`` words at most. A larger
benchmark is taken block by block: a block's automaton is built, broadcast, used and given up, and
what it found is written. The spans of equal texts are united over all blocks before anything is
cut or judged, so the number of blocks changes no result. An automaton is arrays: 12 bytes for each
state and 8 for each transition, some 50 MB a worker for a full block.

Nulls: a null text has no words, a null item id is written as "null". Items without words match
nothing. An empty benchmark leaves all documents as they are; empty tables give empty results.
Equal rows get equal results; columns of any name pass through.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import kept_row, mapped, text_key, written
from .words import ALNUM, Words, slices


class Builder:
    """States of a suffix automaton of several sequences, while it is built: transitions, suffix links, lengths."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def of_length(self, state: int, length: int) -> int:
        """The state of the suffix of that length."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def extend(self, last: int, word: int) -> int:
        """Add a word behind state ``last``; the states of other items stay valid."""
        step = self.next[last].get(word)
        if step is not None and self.length[step] == self.length[last] + 1:
            return step
        if step is None:
            new = self._state(self.length[last] + 1, {}, -1)
            at = last
            while at != -1 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at == -1:
                self.link[new] = 0
            else:
                self.link[new] = self._split(at, word)
            return new
        return self._split(last, word)

    def _split(self, at: int, word: int) -> int:
        step = self.next[at][word]
        if self.length[step] == self.length[at] + 1:
            return step
        copy = self._state(self.length[at] + 1, dict(self.next[step]), self.link[step])
        self.link[step] = copy
        while at != -1 and self.next[at].get(word) == step:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.next.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1


def _ints(values) -> array:
    return array("i", values)


class Automaton:
    """Suffix automaton of several word sequences, in arrays. The transitions of state s are those
    from ``first[s]`` to ``first[s + 1]``, by rising ``word``; ``found`` has the items in which a
    state's window occurs, ``whole`` the lengths and ids of short items that end in a state."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window = window
        self.vocabulary = np.unique(np.concatenate([x for _, x in items])) if items else np.zeros(0, np.uint64)
        coded = [(name, np.searchsorted(self.vocabulary, x).tolist()) for name, x in items if len(x)]
        size = len(self.vocabulary)
        pairs = [np.array(x[:-1]) * size + np.array(x[1:]) for _, x in coded if len(x) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.shortest = min((min(window, len(x)) for _, x in coded), default=0)
        built = Builder()
        for _, x in coded:
            last = 0
            for word in x:
                last = built.extend(last, word)
        found: dict[int, set[int]] = {}
        whole: dict[int, dict[int, set[str]]] = {}
        self.names = sorted({name for name, _ in coded})
        number = {name: i for i, name in enumerate(self.names)}
        for name, x in coded:
            state = 0
            for i, word in enumerate(x, 1):
                state = built.next[state][word]
                if i >= window:
                    found.setdefault(built.of_length(state, window), set()).add(number[name])
            if len(x) < window:
                whole.setdefault(built.of_length(state, len(x)), {}).setdefault(len(x), set()).add(name)
        self.whole = {k: [(n, sorted(v)) for n, v in x.items()] for k, x in whole.items()}
        self.link, self.length = _ints(built.link), _ints(built.length)
        self.first, self.word, self.to = _ints([0]), _ints([]), _ints([])
        for step in built.next:
            edges = sorted(step.items())
            self.word.extend(w for w, _ in edges)
            self.to.extend(s for _, s in edges)
            self.first.append(len(self.word))
        self.found_state = _ints(sorted(found))
        self.found_first, self.found_item = _ints([0]), _ints([])
        for state in self.found_state:
            self.found_item.extend(sorted(found[state]))
            self.found_first.append(len(self.found_item))

    def step(self, state: int, word: int) -> int:
        """The state behind a word; -1 without a transition."""
        low, high = self.first[state], self.first[state + 1]
        at = bisect_left(self.word, word, low, high)
        return self.to[at] if at < high and self.word[at] == word else -1

    def _of_length(self, state: int, length: int) -> int:
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def items_of(self, state: int) -> list[str]:
        at = bisect_left(self.found_state, state)
        return [self.names[i] for i in self.found_item[self.found_first[at] : self.found_first[at + 1]]]

    def runs(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word and number of words of each run that may match, and the code of every word."""
        none = np.zeros(0, np.int64)
        if not len(self.vocabulary) or not len(words.hash):
            return none, none, none
        code = np.searchsorted(self.vocabulary, words.hash)
        code[code == len(self.vocabulary)] = 0
        known = self.vocabulary[code] == words.hash
        joined = np.zeros(len(known), bool)  # with the word before
        near = np.flatnonzero(known[1:] & known[:-1] & (words.doc[1:] == words.doc[:-1]))
        if len(near) and len(self.pairs):
            pair = code[near] * len(self.vocabulary) + code[near + 1]
            at = np.searchsorted(self.pairs, pair)
            at[at == len(self.pairs)] = 0
            joined[near[self.pairs[at] == pair] + 1] = True
        first = np.flatnonzero(known & ~joined)
        group = np.cumsum(known & ~joined) - 1
        count = np.bincount(group[known], minlength=len(first)) if len(first) else none
        return first, count, code

    def match(self, codes: list[int]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Matches (first word, word behind the last) in a run, their items, the longest length."""
        state = length = longest = 0
        spans, items = [], set()
        for i, word in enumerate(codes, 1):
            to = self.step(state, word)
            while state and to < 0:
                state = self.link[state]
                length = self.length[state]
                to = self.step(state, word)
            if to >= 0:
                state = to
                length += 1
            longest = max(longest, length)
            if length >= self.window:
                spans.append((i - self.window, i))
                items.update(self.items_of(self._of_length(state, self.window)))
            at = state if self.whole else 0
            while at > 0:
                for n, names in self.whole.get(at, ()):
                    if n <= length:
                        spans.append((i - n, i))
                        items.update(names)
                at = self.link[at]
        return spans, items, longest


def scan(automaton: Automaton, texts: pa.Array, lengths: bool = True) -> tuple[Words, np.ndarray, list[set[str]], np.ndarray]:
    """The words, which of them are hit, the items of each row, the longest match of each row. Without ``lengths``
    only matches of a window count for the last; with them shorter runs are matched as well, the
    longest first, as far as a row may find a longer match there."""
    words = Words(texts, ALNUM, fold=True)
    hit = np.zeros(len(words.hash), bool)
    items: list[set[str]] = [set() for _ in words.counts]
    longest = np.zeros(len(words.counts), np.int64)
    first, count, code = automaton.runs(words)
    full = count >= automaton.shortest
    for start, n in zip(first[full].tolist(), count[full].tolist(), strict=True):
        spans, names, length = automaton.match(code[start : start + n].tolist())
        row = words.doc[start]
        longest[row] = max(longest[row], length)
        if spans:
            items[row] |= names
            for low, high in spans:
                hit[start + low : start + high] = True
    if lengths:
        rest = np.flatnonzero(~full & (count > longest[words.doc[first]])) if len(first) else first
        rest = rest[np.argsort(-count[rest], kind="stable")]
        for start, n, row in zip(first[rest].tolist(), count[rest].tolist(), words.doc[first[rest]].tolist(), strict=True):
            if n > longest[row]:
                longest[row] = max(longest[row], automaton.match(code[start : start + n].tolist())[2])
    return words, hit, items, longest


def bounds(words: Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and word behind the last of each maximal run of hit words (numbers in the row)."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[words.first] = True
    before = np.append(False, hit[:-1]) if len(hit) else hit
    after = np.append(hit[1:], False) if len(hit) else hit
    low = np.flatnonzero(hit & (~before | edge[:-1]))
    high = np.flatnonzero(hit & (~after | edge[1:])) + 1
    row = words.doc[low]
    return row, low - words.first[row], high - words.first[row]


FOUND = "n_words long, n_hit long, longest long, items array<string>, spans array<struct<first:int,behind:int>>"
SPAN = pa.list_(pa.struct([("first", pa.int32()), ("behind", pa.int32())]))


def blocks_of(benchmark: DataFrame, text: str, key: str, block_words: int) -> tuple[int, DataFrame]:
    """Into how many blocks the benchmark is cut; name, content and block of its items."""
    words = F.coalesce(F.octet_length(text), F.lit(0)) / 2 + 1  # no text has more words
    total = benchmark.agg(F.sum(words)).first()[0] or 0
    blocks = max(1, int(np.ceil(total / block_words)))
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return blocks, benchmark.select(name.alias("name"), F.col(text).alias("content"), F.pmod(F.xxhash64(name, F.col(text)), F.lit(blocks)).alias("block"))


def automaton(items: DataFrame, block: int, window: int) -> Automaton:
    """That of one block, which is collected alone."""
    rows = items.filter(F.col("block") == block).sort("name", "content").collect()
    coded = Words(pa.array([r["content"] for r in rows], pa.string()), ALNUM, fold=True)
    return Automaton([(r["name"], coded.hash[coded.first[i] : coded.first[i + 1]]) for i, r in enumerate(rows)], window)


def _scanner(shared: Broadcast, names: list[str], hit_only: bool = False, lengths: bool = True):
    """A mapInArrow function: the columns ``names`` and FOUND of each row (of which one is ``_text``), or of those only in which some words match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words, hit, items, longest = scan(shared.value, batch.column("_text"), lengths)
            row, low, high = bounds(words, hit)
            pair = pa.StructArray.from_arrays([pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["first", "behind"])
            spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(items) + 1)).astype(np.int32)), pair)
            columns = [pa.array(words.counts.astype(np.int64)), pa.array(words.word_sums(hit).astype(np.int64)), pa.array(longest), pa.array([sorted(x) for x in items], pa.list_(pa.string())), spans]
            found = pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *columns], [*names, "n_words", "n_hit", "longest", "items", "spans"])
            yield found.filter(pa.array(longest > 0)) if hit_only else found

    return run


def _schema(rows: DataFrame, names: list[str]) -> str:
    return "".join(f"`{n}` {rows.schema[n].dataType.simpleString()}, " for n in names) + FOUND


def union(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans in any order as maximal runs."""
    out: list[list[int]] = []
    for first, behind in sorted((s["first"], s["behind"]) for s in spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], behind)
        else:
            out.append([first, behind])
    return [tuple(x) for x in out]


def _united(parts: DataFrame) -> DataFrame:
    """_key, n_hit, longest, items and spans over the blocks' rows of a text."""
    grouped = parts.groupBy("_key").agg(F.max("longest").alias("longest"), F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [union(x) for x in batch.column("spans").to_pylist()]
            n_hit = pa.array([sum(b - a for a, b in x) for x in runs], pa.int64())
            items = pa.array([sorted(set(x)) for x in batch.column("items").to_pylist()], pa.list_(pa.string()))
            spans = pa.array([[{"first": a, "behind": b} for a, b in x] for x in runs], SPAN)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), n_hit, batch.column("longest"), items, spans], ["_key", "n_hit", "longest", "items", "spans"])

    return mapped(grouped, run, "_key binary, n_hit long, longest long, items array<string>, spans array<struct<first:int,behind:int>>")


def _found(rows: DataFrame, blocks: int, items: DataFrame, window: int, lengths: bool = True) -> DataFrame:
    """``rows`` (with ``_text``), with FOUND over all blocks of the benchmark."""
    share = rows.sparkSession.sparkContext.broadcast
    if blocks == 1:
        return mapped(rows, _scanner(share(automaton(items, 0, window)), rows.columns, lengths=lengths), _schema(rows, rows.columns))
    keyed = rows.withColumn("_key", F.unhex(text_key(F.col("_text"))))
    first, parts = None, []
    for block in range(blocks):
        names = ["_key"] if block else keyed.columns
        shared = share(automaton(items, block, window))
        part = mapped(keyed, _scanner(shared, names, bool(block), lengths), _schema(keyed, names))
        if block:
            parts.append(written(part.dropDuplicates(["_key"]), "decontamination"))
        else:
            first = written(part, "decontamination")
        shared.destroy()
    united = _united(reduce(DataFrame.unionByName, [first.filter("longest > 0").dropDuplicates(["_key"]).drop(*rows.columns), *parts]))
    joined = first.select(*rows.columns, "_key", "n_words").join(united, "_key", "left")
    none = F.array().cast("array<string>"), F.array().cast("array<struct<first:int,behind:int>>")
    filled = [F.coalesce(c, default).alias(c) for c, default in (("n_hit", F.lit(0)), ("longest", F.lit(0)), ("items", none[0]), ("spans", none[1]))]
    return joined.select(*rows.columns, "n_words", *filled)


def find(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", window: int = 10, block_words: int = 500_000) -> DataFrame:
    """``key``, n_words, n_hit, longest, items and spans (word numbers) of each row of ``docs``."""
    blocks, items = blocks_of(benchmark, item_text, item_key, block_words)
    found = _found(docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")), blocks, items, window)
    return found.select(F.col("_id").alias(key), "n_words", "n_hit", "longest", "items", "spans")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_text: str = "text", item_key: str = "item_id", window: int = 10, coverage: float = 0.8, block_words: int = 500_000) -> DataFrame:
    """``docs`` without the rows of which more than ``coverage`` of the words are hit; the spans of
    hit words (at least ``window`` words, or a whole short item) are cut out of the other texts."""
    blocks, items = blocks_of(benchmark, item_text, item_key, block_words)
    rows = docs.select(kept_row(docs, text), F.col(text).alias("_text"))
    schema = T.StructType([rows.schema["row"], T.StructField("_text", T.StringType())])
    if blocks == 1:
        scanned = _scanner(docs.sparkSession.sparkContext.broadcast(automaton(items, 0, window)), rows.columns, lengths=False)
        cut = mapped(rows, lambda batches: _cut(scanned(batches), coverage), schema)
    else:
        cut = mapped(_found(rows, blocks, items, window, False), lambda batches: _cut(batches, coverage), schema)
    return cut.select(*[F.col("_text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


def _cut(batches: Iterator[pa.RecordBatch], coverage: float) -> Iterator[pa.RecordBatch]:
    """row and _text of the rows with at most ``coverage`` of their words hit, the texts without these."""
    for batch in batches:
        n_hit, n_words = (batch.column(c).to_numpy() for c in ("n_hit", "n_words"))
        keep = n_hit <= coverage * n_words
        texts = batch.column("_text")
        hit = np.flatnonzero(keep & (n_hit > 0))
        if len(hit):
            chosen, values = pa.array(hit), texts.to_pylist()
            for i, runs in zip(hit.tolist(), batch.column("spans").take(chosen).to_pylist(), strict=True):
                values[i] = without(values[i], [(s["first"], s["behind"]) for s in runs])
            texts = pa.array(values, pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("row"), texts], ["row", "_text"]).filter(pa.array(keep))


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of the spans and what stands between them."""
    words = Words(pa.array([text]), ALNUM, fold=True)
    data, parts, at = words.bytes.tobytes(), [], 0
    for first, behind in spans:
        parts.append(data[at : words.start[first]])
        at = words.end[behind - 1]
    return b"".join([*parts, data[at:]]).decode()


SQL = """
WITH pick AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents, pick),
b AS (SELECT coalesce(item_id::varchar, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark, pick),
win AS (SELECT DISTINCT item, array_to_string(ws[i:i + n - 1], ' ') AS g, n FROM
  (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM (SELECT item, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0))),
sizes AS (SELECT DISTINCT n FROM win),
g AS (SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes)),
h AS (SELECT rid, i, g.n, item FROM g JOIN win ON g.n = win.n AND g.g = win.g),
hit AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM h)) GROUP BY rid),
its AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, len(ws)::bigint AS n_words, coalesce(hit.n, 0)::bigint AS n_hit, coalesce(its.n, 0)::bigint AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.rid = hit.rid LEFT JOIN its ON d.rid = its.rid
"""
