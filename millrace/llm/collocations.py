"""Collocations: phrases whose words occur together far more often than apart, by language.

A phrase can only be frequent if all its parts are. So passes over the texts count hashes of words and pairs, then of
three words whose pairs are frequent, and so on; what is frequent reaches the tasks of the next as a bitmap of
fixed size. It only lets more through if hashes share a bit or if there is more than it has room for: the exact counts
of the last pass decide. There each task counts runs of words in tries of limited depth and serialises them in the
order of their paths, cut by ranges of prefixes (language and two words at most, by their hashes); the sorted runs of a
range meet in one task, which merges them.
In the merged trie a walk towards the root gives the counts of all left parts of a phrase, and its chain of suffix links
those of all right parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Tables, mapped, written
from .words import Words, byte_class, byte_table, mix, range_hashes, raw, slices

U = np.uint64
#: ``[.,;:!?\\x0A-\\x0D]`` ends a piece, ``[\\x20\\x09]`` a word.
BREAKS = ~byte_class([(ord(c), ord(c)) for c in ".,;:!?"] + [(0x0A, 0x0D)])
WORD = ~BREAKS & byte_class([(0x20, 0x20), (0x09, 0x09)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of one trie: some 100 MB of a task.
TRIE_WORDS = 1 << 20
SPACE = pa.scalar(" ", pa.large_string())
#: Bits of the bitmap of what is frequent: 8 MB.
FILTER_BITS = 26
#: Ranges of prefixes for each shuffle partition of the session.
RANGES = 4


def path_hashes(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of paths, of those of their language and of their words."""
    out = lang
    for word in words:
        out = mix(out * U(0x9FB21C651E98DF25) + word)
    return out


def _hashes(strings: pa.Array) -> np.ndarray:
    data, offsets = raw(strings)
    return range_hashes(data, byte_table(False), offsets[:-1], offsets[1:])


class Shard:
    """The words of some texts in their order; ``spelled``: with their bytes."""

    def __init__(self, spelled: bool):
        self.spelled = spelled
        self.langs: dict[str, int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.words = 0

    def add(self, langs: list[str], texts: pa.Array) -> None:
        words = Words(texts, WORD, True)
        if not len(words.start):
            return
        broken = np.zeros(len(words.bytes) + 1, np.int32)
        np.cumsum(BREAKS[words.bytes], out=broken[1:])
        on = np.zeros(len(words.start), bool)
        on[:-1] = (words.doc[1:] == words.doc[:-1]) & (broken[words.start[1:]] == broken[words.end[:-1]])
        lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], np.int32)[words.doc]
        spelled = (LOWER[words.bytes[words.inside]], (words.end - words.start).astype(np.int32)) if self.spelled else ()
        self.parts.append((words.hash, lang, on, *spelled))
        self.words += len(on)

    def _joined(self) -> tuple[pa.Array, list[np.ndarray]]:
        """Languages in their order, and the words' arrays with the language's place there."""
        hashes, lang, on, *spelled = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts = []
        order = sorted(self.langs)
        rank = np.zeros(len(order), np.int32)
        rank[[self.langs[x] for x in order]] = np.arange(len(order))
        return pa.array(order, pa.string()), [hashes, rank[lang], on, *spelled]

    def paths(self, level: int, known: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """Hashes with their counts of the windows of ``level`` words whose parts are in the bitmap ``known``; without
        one, of all words as well."""
        if not self.words:
            return
        names, (name, lang, on) = self._joined()
        for width, hashes, mask in windows(name, _hashes(names)[lang], on, level, known, level - 1):
            if width == level or known is None:
                path, n = np.unique(hashes[mask], return_counts=True)
                for low in range(0, len(path), 1 << 17):
                    yield pa.RecordBatch.from_arrays([pa.array(path[low : low + (1 << 17)].view(np.int64)), pa.array(n[low : low + (1 << 17)])], ["path", "n"])

    def tries(self, depth: int, known: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray]]:
        """Paths of up to ``depth`` words in their order with their counts and the hash of their prefix, from tries of
        TRIE_WORDS words each, of windows with all parts in the bitmap ``known``; a row without a phrase for each
        language has the number of all its words."""
        if not self.words:
            return
        names, (name, lang, on, data, size) = self._joined()
        of_lang = _hashes(names)
        yield pa.table({"lang": names, "phrase": pa.nulls(len(names), pa.string()), "n": np.bincount(lang, minlength=len(names)).astype(np.int64)}), of_lang
        masks = []
        for _, _, mask in windows(name, of_lang[lang], on, depth, known, depth - 1):
            at = np.flatnonzero(mask) if not masks else at  # words that may be frequent; those of a window stay together
            masks.append(np.append(mask, np.zeros(len(name) - len(mask), bool))[at])
        keep = np.zeros(len(name), bool)
        keep[at] = True
        data, size, lang = data[np.repeat(keep, size)], size[at], lang[at]
        del name, keep, at, on
        offsets = np.append(0, np.cumsum(size, dtype=np.int64))
        for first in range(0, len(size), TRIE_WORDS):
            starts, last = min(TRIE_WORDS, len(size) - first), min(len(size), first + TRIE_WORDS + depth - 1)
            text = pa.LargeStringArray.from_buffers(last - first, pa.py_buffer(offsets[first : last + 1] - offsets[first]), pa.py_buffer(data[offsets[first] : offsets[last]]))
            yield _trie(text, lang[first : first + starts], [m[first : first + starts] for m in masks], names)


def windows(name: np.ndarray, of_lang: np.ndarray, on: np.ndarray, depth: int, known: np.ndarray | None, screened: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each width up to ``depth``: the hashes of the windows that start at each word, and whether the window lies in one
    piece and has all parts of up to ``screened`` words, itself included, in ``known``."""
    hashes, mask = of_lang, np.ones(len(name), bool)
    for width in range(1, depth + 1):
        if width > 1:
            hashes, mask = hashes[:-1], mask[:-1] & mask[1:]
            if width == 2:
                mask &= on[: len(mask)]
        hashes = path_hashes(hashes, [name[width - 1 :]])
        if known is not None and width <= screened:
            at = np.flatnonzero(mask)
            mask[at] = _has(known, hashes[at])
        yield width, hashes, mask


def _trie(text: pa.Array, lang: np.ndarray, masks: list[np.ndarray], names: pa.Array) -> tuple[pa.Table, np.ndarray]:
    """One trie, level by level: a node is its parent's number and its last word, and nodes of a
    level are numbered in the order of their paths. ``masks``: where windows of each width start."""
    coded = text.dictionary_encode()
    sort = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.zeros(len(sort), np.int64)
    place[sort] = np.arange(len(sort))
    word, spelled = place[coded.indices.to_numpy()], coded.dictionary.take(pa.array(sort))
    many, hashes = U(len(sort)), _hashes(spelled)
    at, node, of_lang, path, prefix, out = np.arange(len(lang)), lang, np.arange(len(names)), None, _hashes(names), []
    for level, mask in enumerate(masks):
        stay = mask[at]
        at, node = at[stay], node[stay]
        key, node, n = np.unique(node.astype(U) * many + word[at + level].astype(U), return_inverse=True, return_counts=True)
        parent, last = (key // many).astype(np.int64), (key % many).astype(np.int64)
        of_lang, prefix, said = of_lang[parent], prefix[parent], spelled.take(pa.array(last))
        if level < 2:
            prefix = path_hashes(prefix, [hashes[last]])
        path = said if path is None else pc.binary_join_element_wise(path.take(pa.array(parent)), said, SPACE)
        out.append((pa.table({"lang": names.take(pa.array(of_lang)), "phrase": path.cast(pa.string()), "n": n.astype(np.int64)}), prefix))
    rows, prefix = pa.concat_tables([t for t, _ in out]), np.concatenate([p for _, p in out])
    order = pc.sort_indices(rows, [("lang", "ascending"), ("phrase", "ascending")])
    return rows.take(order).combine_chunks(), prefix[order.to_numpy()]


def _serialised(trie: pa.Table, prefix: np.ndarray, ranges: int) -> pa.RecordBatch:
    """A row for each range of prefixes that the trie has: its number, and the sorted paths with their counts."""
    part = ((prefix >> U(32)) * U(ranges) >> U(32)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    trie = trie.take(pa.array(by))
    found, low = np.unique(part[by], return_index=True)
    blobs = []
    for a, b in zip(low, np.append(low[1:], len(by)), strict=True):
        buffer = pa.BufferOutputStream()
        with pa.ipc.new_stream(buffer, trie.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(trie.slice(a, b - a).combine_chunks())
        blobs.append(buffer.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(blobs, pa.binary())], ["range", "trie"])


def _merger(min_count: int):
    """A function for applyInArrow: the sorted runs of a range as one, with the sums of equal paths that reach ``min_count``."""

    def run(table: pa.Table) -> pa.Table:
        runs = pa.concat_tables([pa.ipc.open_stream(x.as_py()).read_all() for x in table.column("trie")])
        runs = runs.sort_by([("lang", "ascending"), ("phrase", "ascending")]).combine_chunks()
        lang, phrase = runs.column("lang"), runs.column("phrase")
        differs = lambda x: pc.fill_null(pc.not_equal(x[1:], x[:-1]), True).to_numpy(zero_copy_only=False)
        total = phrase.is_null().to_numpy()
        new = np.append(True, (differs(phrase) & ~(total[1:] & total[:-1])) | differs(lang))
        first = np.flatnonzero(new)
        n = np.add.reduceat(runs.column("n").to_numpy(), first)
        keep = (n >= min_count) | total[first]
        return runs.take(pa.array(first[keep])).set_column(2, "n", pa.array(n[keep]))

    return run


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & U((1 << FILTER_BITS) - 1)
    return (bits[(bit >> U(5)).astype(np.int64)] >> (bit & U(31)).astype(np.uint32) & np.uint32(1)).astype(bool)


def _slices(batches: Iterator[pa.RecordBatch], spelled: bool) -> Iterator[Shard]:
    """Shards of TRIE_WORDS words, or somewhat more."""
    shard = Shard(spelled)
    for batch in slices(batches, "text"):
        shard.add(batch.column(0).to_pylist(), batch.column(1))
        if shard.words >= TRIE_WORDS:
            yield shard
            shard = Shard(spelled)
    yield shard


def _frequent(texts: DataFrame, depth: int, min_count: int) -> np.ndarray:
    """The bitmap of paths of up to ``depth`` words that occur ``min_count`` times, by the sums of their hashes."""
    spark, known = texts.sparkSession, None
    for level in range(2, max(depth, 2) + 1):
        held = spark.sparkContext.broadcast(known)

        def run(batches: Iterator[pa.RecordBatch], level: int = level, held=held) -> Iterator[pa.RecordBatch]:
            for shard in _slices(batches, False):
                yield from shard.paths(level, held.value)

        often = mapped(texts, run, "path long, n long").groupBy("path").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
        bits = often.select(F.col("path").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("bit"))
        rows = bits.groupBy(F.expr("int(bit div 32)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(bit % 32)))").alias("bits")).toArrow()
        known = np.zeros(1 << (FILTER_BITS - 5), np.uint32) if known is None else known.copy()
        known[rows.column("word").to_numpy()] |= rows.column("bits").to_numpy().astype(np.uint32)
        held.unpersist()
    return known


def counts(docs: DataFrame, tables: Tables, *, text: str, lang: str, depth: int, min_count: int) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``depth`` words that occur ``min_count`` times or more (lang, phrase, n, depth),
    and the words of each language (lang, words)."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    held = texts.sparkSession.sparkContext.broadcast(_frequent(texts, depth - 1, min_count))

    ranges = RANGES * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _slices(batches, True):
            for trie, prefix in shard.tries(depth, held.value):
                if len(trie):
                    yield _serialised(trie, prefix, ranges)

    tries = tables(mapped(texts, run, "range int, trie binary"), "tries")
    merged = tries.groupBy("range").applyInArrow(_merger(min_count), "lang string, phrase string, n long")
    trie = tables(merged, "trie")
    tables.drop(tries)
    held.unpersist()
    total = trie.filter("phrase IS NULL").select("lang", F.col("n").alias("words"))
    return trie.filter("phrase IS NOT NULL").withColumn("depth", F.size(F.split("phrase", " ", -1))), total


def _walked(frequent: DataFrame, depth: int, tables: Tables) -> DataFrame:
    """``frequent`` with lefts (counts of the first 1, 2, … words) and rights (counts of the rest):
    level by level each node takes over its parent's lefts and its suffix link's rights."""
    none = F.array().cast("array<bigint>")
    level = frequent.filter("depth = 1").select("lang", "phrase", "n", none.alias("lefts"), none.alias("rights"))
    out = []
    for d in range(2, depth + 1):
        parent = level.select(F.col("lang").alias("l1"), F.col("phrase").alias("parent"), F.concat("lefts", F.array("n")).alias("lefts"))
        suffix = level.select(F.col("lang").alias("l2"), F.col("phrase").alias("suffix"), F.concat(F.array("n"), "rights").alias("rights"))
        nodes = frequent.filter(F.col("depth") == d).select(
            "lang", "phrase", "n", F.substring_index("phrase", " ", d - 1).alias("of"), F.substring_index("phrase", " ", 1 - d).alias("link")
        )
        nodes = nodes.join(parent, (F.col("lang") == F.col("l1")) & (F.col("of") == F.col("parent")))
        nodes = nodes.join(suffix, (F.col("lang") == F.col("l2")) & (F.col("link") == F.col("suffix")))
        level = tables(nodes.select("lang", "phrase", "n", "of", "link", "lefts", "rights"), f"level-{d}")
        out.append(level)
    walked = out[0]
    for more in out[1:]:
        walked = walked.union(more)
    return walked


def mine(docs: DataFrame, *, text: str = "text", lang: str = "lang", depth: int = 5, min_count: int = 100, cover: int = 100, top: int = 2000, salts: int = 32) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank (from 1), phrase, a (its count), l and r
    (those of its parts), n (words of the language) and score.

    Words are runs without space and tab, lower-cased in A-Z, within pieces between ``. , ; : ! ?``
    and line ends. A phrase of 2 to ``depth`` words that occurs ``min_count`` times scores
    floor(1000 a n / (l r)) at its weakest cut, the first of equal ones. It goes if one longer by a word
    and around it has ``cover`` percent of its count (with any longer one, one longer by a word has it, too).
    A null language is ``und``, a null text empty; equal rows count as often as they stand there. An
    empty table, or one without frequent phrases, gives no rows. Other columns play no part."""
    if depth < 2 or min_count < 1:
        raise ValueError("phrases have two words or more and occur")
    with Tables(docs.sparkSession) as tables:
        frequent, total = counts(docs, tables, text=text, lang=lang, depth=depth, min_count=min_count)
        nodes = _walked(frequent, depth, tables)
        wide = lambda x: x.cast("decimal(38,0)")
        total = total.select(F.col("lang").alias("of_lang"), "words")
        scored = nodes.join(total, F.col("lang") == F.col("of_lang"))
        dividend = wide(F.lit(1000)) * wide(F.col("n")) * wide(F.col("words"))
        scored = scored.withColumn("dividend", dividend).withColumn(
            "cut",
            F.array_min(F.expr(
                "transform(arrays_zip(lefts, rights), (x, i) -> struct("
                "dividend div cast(cast(x.lefts as decimal(38,0)) * cast(x.rights as decimal(38,0)) as decimal(38,0)) as score, i as k, x.lefts as l, x.rights as r))"
            )),
        )
        around = nodes.select("lang", F.col("of").alias("part"), "n").union(nodes.select("lang", "link", "n"))
        around = around.groupBy(F.col("lang").alias("around_lang"), "part").agg(F.max("n").alias("longer"))
        covered = (F.col("lang") == F.col("around_lang")) & (F.col("phrase") == F.col("part")) & (F.lit(100) * F.col("longer") >= F.lit(cover) * F.col("n"))
        left = scored.join(around, covered, "left_anti")
        left = left.select("lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", F.col("words").alias("n"), "cut.score")
        order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
        salted = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
        first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
        ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
        return written(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), spoken AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
runs AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM spoken),
grams AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase FROM runs, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(words)),
counted AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(words))::BIGINT AS n FROM spoken GROUP BY lang),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.n AS a, cut, split(c.phrase, ' ') AS words
  FROM counted c, (SELECT unnest(range(1, 5)) AS cut) WHERE cut < c.k
), parts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.n AS l, y.n AS r, t.n AS n,
    ((1000::HUGEINT * c.a * t.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:cut], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(words[cut + 1:], ' ') JOIN total t ON t.lang = c.lang
), weakest AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ones AS (
  SELECT lang, array_to_string(split(phrase, ' ')[i:i + m - 1], ' ') AS phrase, max(n) AS n
  FROM counted, (SELECT unnest(range(1, 5)) AS i), (SELECT unnest(range(2, 5)) AS m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL
)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase, a, l, r, w.n, score
FROM weakest w LEFT JOIN inner_ones o ON o.lang = w.lang AND o.phrase = w.phrase
WHERE NOT coalesce(100 * o.n >= 100 * a, false) QUALIFY rank <= 2000
"""
