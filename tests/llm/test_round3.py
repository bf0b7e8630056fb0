"""Collocations, chat formatting and vector codes against plain versions and on odd input."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import archives, chat, collocations, decontamination, repeats, vector_codes
from millrace.llm.shared import Tables


def plain_collocations(docs, depth, least, cover, top):
    counts, total = Counter(), Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, depth + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {x: n for x, n in counts.items() if n >= least}
    rows = {}
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        longer = [n for (other, w), n in often.items() if other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if any(100 * n >= cover * a for n in longer):
            continue
        score, k = min((1000 * a * total[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words)))
        rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, found in rows.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])}


@pytest.mark.parametrize("cover, words", [(100, 1 << 21), (60, 37)])
def test_collocations(spark, monkeypatch, cover, words):
    monkeypatch.setattr(collocations, "TRIE_WORDS", words)
    draw = random.Random(3)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "x\x1f", "a" * 40, "42"]
    docs = [
        (draw.choice(["en", "fr", None]), "".join(draw.choice(vocabulary) + draw.choice([" ", " ", "\t ", ", ", "\n", " new york city "]) for _ in range(draw.randrange(60))))
        for _ in range(80)
    ] + [("en", None), ("en", ""), ("en", " .,"), (None, "the of the of the of")] * 2
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    found = collocations.mine(df, depth=4, min_count=5, cover=cover, top=25)
    assert {tuple(r) for r in found.collect()} == plain_collocations(docs, 4, 5, cover, 25)
    with pytest.raises(ValueError):
        collocations.mine(df, depth=1)


def test_collocations_of_odd_tables(spark):
    empty = spark.createDataFrame([], "phrase string, lang string, text string, n long")
    assert collocations.mine(empty).count() == 0
    rare = spark.createDataFrame([("en", "each word once", 1)], "lang string, text string, phrase int")
    assert collocations.mine(rare, min_count=2).count() == 0
    one = collocations.mine(spark.createDataFrame([("en", "a b " * 200_000, 1)], "lang string, text string, n int"), depth=2)
    assert [tuple(r) for r in one.select("phrase", "a").collect()] in ([("a b", 200_000), ("b a", 199_999)],)


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10**12
    with Tables(spark) as tables:
        rows = [("en", "a", big, 1), ("en", "b", big, 1), ("en", "a b", big, 2)]
        frequent = tables(spark.createDataFrame(rows, "lang string, phrase string, n long, depth int"), "frequent")
        monkeypatch.setattr(collocations, "counts", lambda *_, **__: (frequent, spark.createDataFrame([("en", 4 * big)], "lang string, words long")))
        assert collocations.mine(spark.range(1), depth=2).first()["score"] == 1000 * big * 4 * big // (big * big)


ODD = ["", "</turn>", "\\</turn>", "\\\\<turn user>\n", "a\n<and>\nb", "<and>", "\n", "\n</turn>\n", "é\\", "### User: x"]


def test_chat_goes_there_and_back(spark):
    draw = random.Random(5)
    rows = [(c, t, draw.choice(["user", "assistant", "sys>\n%3E<", "", None]), draw.choice([*ODD, None]), "x") for c in range(40) for t in range(draw.randrange(1, 9))]
    rows += [(None, None, "user", "lost", "x"), (None, None, "user", "lost", "x"), (99, 1, "b", "2", "x"), (99, 1, "a", "3", "x"), (99, None, "c", "1", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    out = chat.format(df)
    got = {r["conv_id"]: r for r in out.select("*", chat.parsed(F.col("formatted")).alias("turns"), chat.learnt(F.col("formatted"), F.col("loss")).alias("learnt")).collect()}
    key = lambda r: ((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "")
    for c, own in itertools.groupby(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), key=lambda r: r[0]):
        told = [(r[2] or "", r[3] or "") for r in sorted(own, key=key)]
        assert [tuple(t) for t in got[c]["turns"]] == told
        assert got[c]["learnt"] == "".join(t for r, t in told if r == "assistant")
        assert got[c]["n_turns"] == len(told)
        blocks = len([1 for _ in itertools.groupby(r for r, _ in told)])
        assert len(re.findall("^<turn ", got[c]["formatted"], re.M)) == blocks
    assert chat.format(df.limit(0)).count() == 0


def test_long_conversations_and_texts(spark):
    turns = spark.range(3000).selectExpr("1L as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role", "concat('é', id) as text")
    long = spark.createDataFrame([(2, 0, "assistant", "<and>\\" * 2_000_000)], "conv_id long, turn long, role string, text string")
    out = chat.format(turns.union(long))
    got = {r["conv_id"]: r for r in out.select("conv_id", chat.learnt(F.col("formatted"), F.col("loss")).alias("text"), F.size(chat.parsed(F.col("formatted"))).alias("n")).collect()}
    assert got[1]["text"] == "".join(f"é{i}" for i in range(3000) if i % 3) and got[1]["n"] == 3000
    assert got[2]["text"] == "<and>\\" * 2_000_000


def plain_codes(rows, parts, entries, rounds):
    kept = sorted((i, [math.floor(1024 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v in kept[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for _, v in kept:
                held[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(x) // len(x) for x in zip(*own, strict=True)] if own else e for own, e in zip(held, books[p], strict=True)]
    codes = {i: [near(cut(v, p), books[p]) for p in range(parts)] for i, v in kept}
    text = ",".join(str(x) for book in books for e in book for x in e)
    return {i: ("".join(f"{j:02x}" for _, j in x), sum(d for d, _ in x)) for i, x in codes.items()}, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("scale", [1.0, 0.004, 9000.0])
def test_vector_codes(spark, scale):
    draw = np.random.default_rng(7)
    vectors = np.round(draw.normal(size=(300, 8)) * 3) * scale / 3 if scale < 1 else draw.normal(size=(300, 8)) * scale
    vectors[200:] = vectors[100]  # a hot vector
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(-1, None), (-2, [float("nan")] * 8), (-3, [float("inf")] * 8), (-4, [None] * 8), (-5, [])]
    df = spark.createDataFrame([(*r, "c", r[0] % 3 or None) for r in rows + odd], "vec_id long, embedding array<double>, code string, label int").repartition(3)
    coded, books = vector_codes.compress(df, parts=4, entries=20, rounds=4)
    expected, digest = plain_codes(rows, 4, 20, 4)
    got = coded.collect()
    assert {r["vec_id"]: (r["code"], r["error"]) for r in got} == expected and len(got) == len(rows)
    assert books.sha256 == digest
    summed = Counter()
    for r in got:
        summed[r["label"]] += r["error"]
    assert all(r["label_error"] == summed[r["label"]] for r in vector_codes.label_errors(coded).collect())


def test_pruning_skips_most_distances():
    draw = np.random.default_rng(1)
    centres = draw.integers(-40000, 40000, (32, 4))
    points = centres[draw.integers(0, 32, 4000)] + draw.integers(-50, 50, (4000, 4))
    before = vector_codes.Codebooks(centres[None].astype(np.int64))
    bounds = vector_codes.first_bounds(points, before.entries[0])
    after = vector_codes.Codebooks(before.entries + 3, before.entries)
    assigned, upper, lower, computed = vector_codes.again(points, after.entries[0], after.moved[0], after.apart[0], *bounds)
    square = vector_codes.squares(points, after.entries[0])
    assert (assigned == square.argmin(1)).all() and computed < 0.1 * square.size
    assert (upper * upper >= square[np.arange(4000), assigned]).all() and (lower * lower <= square).all()


def test_vector_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, numbers int"
    coded, books = vector_codes.compress(spark.createDataFrame([], schema))
    assert coded.count() == 0 and books.entries.shape[1] == 0 and coded.columns == ["vec_id", "numbers", "code", "error"]
    coded, _ = vector_codes.compress(spark.createDataFrame([(None, [1.0] * 4, 1), (1, [2.0] * 4, 1), (1, [2.0] * 4, 1), (0, [0.5] * 4, 1), (5, [1.0] * 8, 1)], schema))
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["code"], r["error"]) for r in coded.collect()) == [(-1, "03030303", 0), (0, "00000000", 0), (1, "01010101", 0), (1, "01010101", 0)]
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 3, 1)], schema))
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(spark.createDataFrame([(1, [3e30] * 4, 1)], schema))


def arc(records, declared=0):
    head = b"1 0 own\nURL IP-address Archive-date Content-type Archive-length\n"
    out = b"filedesc://x.arc 0.0.0.0 20240101000000 text/plain %d\n%s\n" % (len(head), head)
    for i, content in enumerate(records):
        out += b"http://x.example/%d 1.2.3.4 20240102030405 text/html %d\n%s\n" % (i, len(content) + declared * (i == len(records) - 1), content)
    return out


def test_archives_as_they_are_found(spark, tmp_path):
    plain = b"HTTP/1.0 200 OK\nX-Page-Id: home\nContent-Type: text/html\n\n<p>x</p>"
    for folder in ("a", "b"):
        (tmp_path / "arcs" / folder).mkdir(parents=True)
        (tmp_path / "arcs" / folder / "one.arc").write_bytes(arc([plain, b"HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\nbody\n\nmore"]))
    (tmp_path / "arcs" / "a" / "cut.arc").write_bytes(arc([plain, b"HTTP/1.1 200 OK\r\n\r\nz"], declared=99))
    (tmp_path / "arcs" / "a" / "junk.arc.gz").write_bytes(b"\x1f\x8bnot gzip")
    found = archives.convert(spark, str(tmp_path / "arcs")).collect()
    kinds = Counter(r["type"] for r in found)
    assert kinds == {"warcinfo": 3, "response": 5, "broken": 2}
    assert {bytes(r["payload"]) for r in found if r["type"] == "response"} == {b"<p>x</p>", b"body\n\nmore"}
    assert {r["page_id"] for r in found} == {None, 7} and len({r["record_id"] for r in found}) == len(found)
    assert sorted(r["uri"] for r in found if r["type"] == "broken") == ["a/cut.arc", "a/junk.arc.gz"]
    archives.write_warc(archives.convert(spark, str(tmp_path / "arcs")), str(tmp_path / "warc"))
    read = archives.read_warc(spark, str(tmp_path / "warc")).collect()
    assert Counter(r["type"] for r in read) == {"warcinfo": 3, "response": 2, "revisit": 3} and all(r["digest_ok"] for r in read if r["type"] == "response")


@pytest.mark.parametrize("block", [500_000, 20])
def test_longest_matches_are_those_of_any_length(spark, block):
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(14)) for i in range(6)]
    docs = [(i, text(25)) for i in range(40)] + [(100, " ".join(items[2][1].split()[2:11])), (101, "zz yy"), (102, None), (103, items[3][1])]

    def plain(words):
        best = 0
        for _, item in items:
            own = item.split()
            for i, j in itertools.product(range(len(words)), range(len(own))):
                n = 0
                while i + n < len(words) and j + n < len(own) and words[i + n] == own[j + n]:
                    n += 1
                best = max(best, n)
        return best

    found = decontamination.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_words=block)
    got = {r["doc_id"]: r["longest"] for r in found.collect()}
    assert got == {i: plain((t or "").split()) for i, t in docs} and got[100] == 9


def test_equal_windows_of_several_shards(monkeypatch):
    """Digests that agree in their first half only are not taken for equal."""
    import pyarrow as pa

    one, two = np.array([3, 3, 5], np.uint64), np.array([3, 5, 9], np.uint64)
    table = pa.table({
        "names": [one.tobytes(), two.tobytes()], "seconds": [np.array([1, 2, 7], np.uint64).tobytes(), np.array([2, 8, 1], np.uint64).tobytes()],
        "contexts": [np.array([10, 11, 12]).tobytes(), np.array([20, 21, 22]).tobytes()], "starts": [np.zeros(3, np.int32).tobytes()] * 2,
    })
    assert repeats._merged(table).column("context").to_pylist() == [11, 20]


def test_copies_are_compared_once(spark):
    from millrace.llm import licenses

    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    known = spark.createDataFrame([("MIT", text)], "license string, text string")
    docs = spark.createDataFrame([(i, text) for i in range(50)] + [(99, "other words")], "doc_id long, text string")
    found = licenses.matches(docs, known)
    assert found.select("text_id").distinct().count() == 1 and licenses.scan(docs, known).filter("n_matches > 0").count() == 50
