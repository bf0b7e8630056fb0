"""Operators on the rows that are easy to get wrong."""

import itertools
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import numbers, text
from millrace.operators import annotate, history, judge, packs, pairs, render, rows, scores, sections
from millrace.operators.rules import Rule, first_match, lines_with, range_of, windows
from millrace.sources import documents, jsonl
from millrace.streaming import mails

c = F.col


def one(spark, value, build, ddl="t string"):
    """The value of ``build(column)`` for one value."""
    return spark.createDataFrame([(value,)], ddl).select(build(c("t")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("build", "value", "want"),
    [
        (text.dedupe_key, " Re:  Re: Hello　World ", "re: hello world"),
        (text.dedupe_key, None, ""),
        (text.mail_address, "Ann <Ann@X.org>", "ann@x.org"),
        (text.mail_address, " Bob@y.org ", "bob@y.org"),
        (text.html_to_text, "<style>p{}</style>a<br/>b<p>c</p>\n\n\n\nd", "a\nbc\n\nd"),
        (text.document_to_text, "<!-- x --><p>a &amp; b</p><noscript>n</noscript><div>c</div>", "a & b\nc"),
        (text.join_cjk, "必 須 a b", "必須 a b"),
        (text.squeeze, "a\n\n\n\n\nb", "a\n\n\nb"),
        (text.heading_key, "【必須 スキル】", "必須スキル"),
        (lambda x: text.truncate_at_line(x, 10), "123456789\nabcdef", "123456789"),
        (lambda x: text.truncate_at_line(x, 10), "1234\n56789abcdef", "1234\n56789"),
        (lambda x: text.truncate_at_line(x, 10, "…"), "short", "short"),
        (lambda x: text.quote(x, 3), "abcd", "abc…"),
        (lambda x: text.strip_modifiers(x, ["の経験", "できる方"]), "Javaの経験者", "Java"),
        (lambda x: text.is_soft_skill(x, ["協調性"]), "協調性のある方", True),
        (lambda x: text.is_soft_skill(x, ["協調性"]), "協調性とJava", False),
        (lambda x: text.count_of(x, "aa"), "aaaaa", 2),
        (lambda x: text.around(x, "key", 3, 4), "0123key4567", "123key4567"),
        (lambda x: text.around(x, "none", 3, 4), "0123key4567", None),
        (lambda x: text.wildcard(x, "a?c*"), "abcd", True),
        (lambda x: text.wildcard(x, "a[!x]c*"), "axc", False),
        (lambda x: text.wildcard(x, "a.c"), "abc", False),
        (lambda x: x.rlike(text.flexible("単価")), "単 価", True),
        (text.quality_reason, " \n", "empty"),
        (text.quality_reason, "<html><body>x", "html"),
        (text.quality_reason, "12/34", "short"),
        (text.quality_reason, "x" * 40, "title_only"),
        (text.quality_reason, "x" * 40 + "\n" + "y" * 40, None),
        (text.redact, "a@b.org 10.0.0.1 http://x.y/z 03-1234-5678", "[EMAIL] [IP] [URL] [PHONE]"),
        (lambda x: F.array_join(text.urls(x), " "), "see http://a.b/c). and https://d.e", "http://a.b/c https://d.e"),
        (lambda x: text.without_urls_near(x, "配信停止"), "a\n配信停止はこちら\nhttp://x.y\nb", "a\nb"),
        (text.mask_noise, "a http://x.y/z b", "a   b"),
        (lambda x: text.failure_reason(F.lit("sheet"), F.lit("drive"), x), "HTTP 403", "sheet[drive] needs permission"),
        (lambda x: text.sanitised(x, [("ad", "BUY")])["text"], "hello\nBUY now\nx@y.org", "hello\n[EMAIL]"),
        (lambda x: text.sanitised(x, [("ad", "BUY")])["text"], "BUY now", "BUY now"),
        (numbers.digit, "五", 5),
        (numbers.digit, "7", 7),
        (numbers.digit, "x", None),
        (lambda x: numbers.run_date(x).cast("string"), "20240230", None),
        (lambda x: numbers.run_date(x).cast("string"), "20240229", "2024-02-29"),
        (lambda x: numbers.marks(F.lit("Spring Boot"), x), "uses spring", True),
        (lambda x: annotate.label_value(x, "最寄駅"), "【最寄駅】\n渋谷\nx", "渋谷"),
        (lambda x: annotate.label_value(x, "単価"), "単価: 60万", "60万"),
        (lambda x: sections.trim_signature(x, "案件", "TEL"), "案件\n1\n2\n3\n4\n-----\nABC社\nTEL 03", "案件\n1\n2\n3\n4"),
        (lambda x: rows.drop_lines(x, ["^お世話"], "^--"), "お世話です\na\n--\nb", "a"),
        (lambda x: lines_with(x, "単価", 1), "a\n単価\n60万\nb", "単価\n60万"),
        (lambda x: windows(x, "歳", 2, 1), "まで45歳です", "45歳で"),
        (lambda x: range_of(x, "([0-9]+)~([0-9]+)", factor=10)["max"], "5~7", 70),
        (lambda x: packs.remote(x)["value"], "フルリモート可", "fullremote"),
        (lambda x: packs.remote(x)["value"], "リモート不可", "onsite"),
        (lambda x: packs.remote(x)["source"], "特になし", "default"),
        (lambda x: packs.foreign_ok(x)["value"], "外国籍不可", False),
        (lambda x: packs.freelance_ok(x)["value"], "個人事業主可", True),
        (packs.flow_level, "商流: 貴社2社先まで", 3),
        (lambda x: packs.contract(x)["value"], "契約: 準委任", "quasi_mandate"),
        (lambda x: packs.age_limit(x)["value"], "年齢: 45歳まで", 45),
        (lambda x: packs.age_limit(x)["value"], "50歳以上はNG", 49),
        (lambda x: packs.own_age(x)["value"], "氏名: A.B 34歳", 34),
        (lambda x: packs.project_price(x)["value"], "単価: ~65万", 650000),
        (lambda x: packs.project_price(x)["value"], "単価\n時給 3000円", 480000),
        (lambda x: packs.nationality(x)["value"], "国籍: 日本", "japanese"),
        (lambda x: packs.employment(x)["value"], "弊社正社員", "employee"),
        (lambda x: packs.workload(x)["min"], "稼働率: 80~100%", 80),
        (lambda x: packs.vendor_flow(x, F.lit("a@own.jp"), "own.jp"), "1社下", 11),
        (lambda x: render.recipients(F.lit(" "), x), "A <a@b.c>, a@b.c, none", "a@b.c"),
        (lambda x: render.sequence_name(x.cast("int")), "7", "_pair_0007"),
        (lambda x: render.affiliation(x.cast("int"), F.lit("employee")), "21", "partner+1/employee"),
        (lambda x: jsonl.base64url(x).cast("string"), "w6k_", "é?"),
    ],
)
def test_columns(spark, build, value, want):
    assert one(spark, value, build) == want


def test_nfkc(spark):
    assert one(spark, "ＡＢ①", text.nfkc) == "AB1" and one(spark, None, text.nfkc) is None


def test_choices(spark):
    df = spark.createDataFrame([(None, " ", " x "), (None, None, None)], "a string, b string, c string")
    got = df.select(text.first_nonempty(c("a"), c("b"), c("c")).alias("v"), text.with_source(("a", c("a")), ("c", c("c"))).alias("s")).collect()
    assert [g["v"] for g in got] == [" x ", None] and [g["s"]["source"] for g in got] == ["c", "none"]
    lists = spark.createDataFrame([(["b", "A", "a", "B", "c"],)], "x array<string>")
    assert lists.select(text.distinct_ignoring_case(c("x")).alias("v")).first()["v"] == ["b", "A", "c"]
    found = F.array(*map(F.lit, ["http://z.org/1", "http://m.a/2", "http://z.org/1"]))
    assert lists.select(text.by_priority(found, [("mobile", "^m\\.")]).alias("v")).first()["v"] == ["http://m.a/2", "http://z.org/1"]


PREDICATES = {
    "budget": (lambda p, r: pairs.budget(p, r, 10), lambda p, r: p is None or r is None or p >= r + 10, [None, 0, 5, 10, 15]),
    "age": (pairs.age, lambda p, r: p is None or r is None or r == 1 or r <= p, [None, 1, 30, 100]),
    "location": (lambda p, r: pairs.location(p.cast("string"), r.cast("string"), F.lit("hybrid")), lambda p, r: p is None or r is None or p == r, [None, 1, 2]),
    "tier": (lambda p, r: pairs.tier(p, r, pairs.TIERS), lambda p, r: p is None or r is None or p == 0 or r in pairs.TIERS.get(p, ()), [None, 0, 1, 2, 3, 9, 10, 11, 22]),
}


@pytest.mark.parametrize("name", PREDICATES)
def test_predicates(spark, name):
    build, want, values = PREDICATES[name]
    df = spark.createDataFrame(list(itertools.product(values, values)), "p int, r int").select("p", "r", build(c("p"), c("r")).alias("v"))
    assert all(x["v"] is want(x["p"], x["r"]) for x in df.collect())


def test_list_predicates(spark):
    lists = [None, [], ["a"], ["b", "x"], ["x"]]
    df = spark.createDataFrame(list(itertools.product(lists, lists)), "p array<string>, r array<string>")
    got = df.select("p", "r", pairs.skills(c("p"), c("r"), None, ["x"]).alias("s"), pairs.phases(c("p"), c("r"), ["a", "b"]).alias("h")).collect()
    for x in got:
        p, r = set(x["p"] or ()), set(x["r"] or ())
        assert x["s"] is bool((p & r) - {"x"})
        assert x["h"] is (not p or not r or bool(p & r & {"a", "b"}))
    kinds = [None, "onsite", "hybrid", "fullremote", "odd"]
    df = spark.createDataFrame(list(itertools.product(kinds, kinds)), "p string, r string")
    for x in df.select("p", "r", pairs.compatible(c("p"), c("r"), pairs.REMOTE).alias("v")).collect():
        assert x["v"] is (x["p"] is None or x["r"] is None or x["p"] not in pairs.REMOTE or x["r"] in pairs.REMOTE[x["p"]])


def test_cascade_audit_is_the_whole(spark):
    a, b = spark.range(30).select(c("id").alias("p")), spark.range(20).select(c("id").alias("r"))
    stages = [("budget", pairs.budget(c("p"), c("r"), 3)), ("age", pairs.age(c("p") % 7, c("r") % 5)), ("even", (c("p") + c("r")) % 2 == 0)]
    whole = pairs.product(a, b)
    audit, fast = pairs.cascade(whole, stages, True), pairs.cascade(whole, stages)
    assert audit.count() == 600 and {tuple(x) for x in audit.filter("first_failed IS NULL").select("p", "r").collect()} == {tuple(x) for x in fast.collect()}
    left = whole
    for name, condition in stages:
        kept, rejected = rows.split(left, condition)
        assert rejected.count() == audit.filter(c("first_failed") == name).count()
        left = kept


def test_products_of_large_sides(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BROADCAST_ROWS", 7)
    a, b = spark.range(20).select(c("id").alias("p")), spark.range(15).select(c("id").alias("r"))
    assert pairs.product(a, b).distinct().count() == 300
    assert pairs.product(a, b.limit(5), c("p") > c("r")).count() == sum(p > r for p in range(20) for r in range(5))


def test_containment(spark):
    df = spark.createDataFrame([(["java"], [], ["java"], []), (["java"], ["design"], ["java"], ["design"]), (["java"], ["design"], [], ["java", "design"]), ([], [], ["x"], []), (["go"], [], [], [])], "q array<string>, s array<string>, a array<string>, b array<string>")
    got = [x["v"] for x in df.select(pairs.containment(c("q"), c("s"), c("a"), c("b")).alias("v")).collect()]
    assert [(g["matched"], g["source"], g["reason"]) for g in got] == [
        (True, "sheet", "matched_required_skill_only"), (False, "none", "not_matched"), (True, "body", "matched_required_skill_and_phase"),
        (False, "none", "rejected_no_required_conditions"), (False, "none", "not_matched"),
    ]


def test_row_operators(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "b", 0), (1, None, 5), (2, None, 3), (None, "z", 4)], "k int, o string, i int")
    assert {(x["k"], x["i"]) for x in rows.keep_latest(df, ["k"], "o", "i").collect()} == {(1, 0), (2, 3), (None, 4)}
    assert {(x["k"], x["i"]) for x in rows.keep_last(df.filter("k IS NOT NULL"), ["k"], "i").collect()} == {(1, 5), (2, 3)}
    with pytest.raises(ValueError):
        rows.keep_last(df, ["k"], "i")
    kept, rejected = rows.split(df, c("o") == "b")
    assert (kept.count(), rejected.count()) == (2, 3)
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    assert rows.lookup(df, dim, "k").count() == 5
    with pytest.raises(Exception, match="no row for"):
        rows.lookup(df, dim, "k", strict=True).collect()
    good, bad = rows.lookup_or_error(df.filter("k IS NOT NULL"), dim, "k", "missing")
    assert (good.count(), bad.first()["error"]) == (3, "missing")
    assert {k: v.count() for k, v in rows.route(df, "o", ["b"], "unknown").items()} == {"b": 2, "unknown": 3}
    counts = rows.with_empty(df.groupBy("o").agg(F.count("*").alias("n")), "o", ["b", "q"])
    assert {tuple(x) for x in counts.collect()} == {("b", 2, "ok"), ("q", 0, "no_match")}
    with pytest.raises(ValueError):
        rows.same_count(df, dim)


def test_scores(spark):
    rates = [0.0, 0.1, 0.2, 0.4, 0.6, 0.8, 0.99, 1.0, 1.5]
    got = spark.createDataFrame([(r,) for r in rates], "r double").select(scores.band(c("r")).alias("b")).collect()
    assert [g["b"] for g in got] == ["match_0", "match_1_19", "match_20_39", "match_40_59", "match_60_79", "match_80_99", "match_80_99", "match_100", "match_100"]
    lists = spark.createDataFrame([(None,), ([],), ([True, None, False],)], "f array<boolean>").select(scores.rate(c("f")).alias("r")).collect()
    assert [x["r"] for x in lists] == [0.0, 0.0, pytest.approx(1 / 3)]
    pair = spark.createDataFrame([(0.0, 0.0), (3.0, 0.0), (0.2, 0.0), (3.0, 2.9), (1.0, 2.0)], "a double, b double")
    assert [x["k"]["label"] for x in pair.select(scores.classify({"resource": c("a"), "project": c("b")}).alias("k")).collect()] == ["unknown", "resource", "ambiguous", "ambiguous", "project"]
    plan = spark.createDataFrame([(900_000, 600_000), (700_000, 650_000), (5, 5), (None, 1)], "p long, r long").select(numbers.price_plan(c("p"), c("r")).alias("m")).collect()
    assert [(x["m"]["target"], x["m"]["for_demand"], x["m"]["for_supply"]) for x in plan] == [(270_000, 870_000, 630_000), (50_000, 700_000, 650_000), (None, None, None), (None, None, None)]


def test_restore_uses_each_row_once(spark):
    wanted = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "b", "x")], "w int, id string, k string")
    cache = spark.createDataFrame([(10, "a", "x"), (11, "q", "x"), (12, "a", "y")], "c int, id string, k string")
    got = {x["w"]: (x["tier"], x["c"]) for x in history.restore(wanted, cache, ["id", "k"], ["k"], "w", "c").collect()}
    assert got == {1: ("exact", 10), 2: ("loose", 11), 3: ("exact", 12), 4: (None, None)}


def test_merge_reports_what_is_left(spark):
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "i int, k string")
    restored, new = spark.createDataFrame([(1, "a")], "i int, k string"), spark.createDataFrame([(1, "a"), (2, "a"), (3, "c")], "i int, k string")
    merged, errors = history.merge(old, restored, new, ["k"], "i")
    assert merged.count() == 2
    assert sorted((x["k"], x["error"]) for x in errors.collect()) == [("a", "unused_new_ai_result"), ("b", "merge_source_not_found"), ("c", "unused_new_ai_result")]


def test_run_state(spark, tmp_path):
    state = history.RunState(spark, str(tmp_path / "state"))
    assert state.latest() is None and state.read("history") is None
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "k string")
    assert state.commit(frame("a"), frame("ca"), frame()) == 1
    assert state.commit(frame("b"), frame("cb"), frame("error")) == 2
    assert [x["k"] for x in state.read("history").collect()] == ["b"] and [x["k"] for x in state.read("cache").collect()] == ["ca"]
    seen, new = history.seen_and_new(frame("b", "c"), state.read("history"), ["k"])
    assert (seen.count(), new.first()["k"]) == (1, "c")


def test_annotation(spark):
    df = spark.createDataFrame([("Java and JavaScript, node.js; C言語とSQL",), ("",), (None,)], "text string")
    got = annotate.annotated(df, {"lang": ["Java", "JavaScript", "C言語"], "db": ["SQL", "js"]}, aliases={"C言語": "C"}).collect()
    assert got[0]["terms"] == ["Java", "JavaScript", "C", "SQL"] and got[0]["by_category"] == {"lang": ["Java", "JavaScript", "C"], "db": ["SQL"]}
    assert got[1]["terms"] == got[2]["terms"] == []
    groups = df.select(annotate.first_of_groups(c("text"), {"a": ["SQL"], "b": ["Java"]}).alias("v")).collect()
    assert groups[0]["v"] == ["b", "a"]
    skills = df.select(annotate.primary(F.array(F.lit("Go"), F.lit("SQL")), c("text")).alias("v")).collect()
    assert skills[0]["v"] == ["SQL"] and skills[2]["v"] == ["Go", "SQL"]


def test_sections(spark):
    body = "Hello\nRequired skills: Java・SQL\n- Spring\none of the following: design\n  - API\nLocation: Tokyo\nRust\nPreferred skills\n* Go\n" + "x" * 90 + "\n---\n- after"
    assert sections.Sections().scanner().scan(body) == (["Java", "SQL", "Spring", "API design"], ["Go"])
    df = sections.sectioned(spark.createDataFrame([(body,), (None,)], "text string")).collect()
    assert df[0]["optional_skills"] == ["Go"] and df[1]["required_skills"] == []


def test_rules(spark):
    rules = [Rule("no ([0-9]+)", group=1, plus=-1), Rule("any", 100)]
    df = spark.createDataFrame([("no 50 any",), ("any",), ("none",), (None,)], "t string")
    got = [x["v"] for x in df.select(first_match(c("t"), rules, kind="int").alias("v")).collect()]
    assert [(g["value"], g["source"], g["raw"]) for g in got] == [(49, "extracted", "no 50"), (100, "extracted", "any"), (None, "default", None), (None, "default", None)]


def test_judges(spark):
    df = spark.createDataFrame([(["Java", "Go lang"], "java and golang"), ([], "x"), (["a"], " "), (["a"], None)], "required_skills array<string>, skillsheet string")
    got = judge.judged(df).collect()
    assert [r["match"] for r in got[0]["results"]] == [True, True]
    assert [x["error"] for x in got] == [None, "missing_project_required_skills", "missing_resource_skillsheet", "missing_resource_skillsheet"]
    bad = lambda answer: [x["error"] for x in judge.judged(df.limit(1), lambda s, t: answer).collect()]
    assert bad([]) == ["llm_parse_error"] and bad([{"skill": "Java", "match": 1, "note": "x"}] * 2) == ["invalid_output_schema"]
    assert bad([{"skill": s, "match": True, "note": "x" * 31} for s in ("Java", "Go lang")]) == ["invalid_output_schema"]
    soft = judge.judged(df.limit(1)).select(judge.override_soft(c("results"), lambda s: s == "Go lang").alias("r")).first()["r"]
    assert soft[1]["match"] and soft[1]["note"] == "soft skill"
    checks = spark.createDataFrame([([],), ([("human_review",)],), ([("human_review",), ("not_confirmed",)],)], "k array<struct<recheck_match:string>>")
    assert [x["s"] for x in checks.select(judge.recheck_status(c("k")).alias("s")).collect()] == ["confirmed", "human_review", "not_confirmed"]


def test_rendering(spark):
    df = spark.createDataFrame([(1, None, "a@b.c")], "i int, x string, m string")
    assert df.select(render.block("t", {"i": c("i"), "x": c("x")}).alias("v")).first()["v"] == "[t]\ni: 1\nx: -"
    assert df.select(render.notes([("b", c("i") == 1), ("a", c("i") > 0), ("c", c("x") == "q")]).alias("v")).first()["v"] == ["a", "b"]
    two = render.drafts(df, {"demand": (c("m"), F.lit("s"), F.lit("hi")), "supply": (c("m"), F.lit("s"), F.lit("ho"))}).collect()
    assert [(x["mode"], x["body"]) for x in two] == [("demand", "hi"), ("supply", "ho")]


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "x")
    df = spark.createDataFrame([("1", "é", None), ("2", None, "d")], "message_id string, body_text string, part string")
    jsonl.write_jsonl(df, path)
    assert {(x[0], x[1], x[2]) for x in jsonl.read_jsonl(spark, path, "message_id string, body_text string, part string").collect()} == {("1", "é", None), ("2", None, "d")}
    (tmp_path / "bad.jsonl").write_text('{"message_id": "1"}\n\n{broken\n')
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), schemas.BODY).collect()
    loose = jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), schemas.BODY, strict=False).cache()
    assert sorted(str(x["_corrupt"]) for x in loose.collect()) == ["None", "{broken"]
    dated = spark.createDataFrame([("20240101",), ("20240102",)], "d string")
    assert jsonl.latest_partition(dated, "d").first()["d"] == "20240102" and jsonl.latest_partition(dated, "d", "20240101").count() == 1
    head = spark.createDataFrame([([("To", "a"), ("SUBJECT", "b"), ("to", "c")],)], "h array<struct<name:string,value:string>>")
    assert head.select(jsonl.headers(c("h")).alias("v")).first()["v"] == {"subject": "b", "to": "c"}
    assert jsonl.weighted(jsonl.sections("[A]\n# c\nx,2\ny\n[B]\nz,0.5")["A"]) == {"x": 2.0, "y": 1.0}
    assert jsonl.terms("lang:\n  - Java\n  - 'C#'\ndb:\n- SQL") == {"lang": ["Java", "C#"], "db": ["SQL"]}
    assert jsonl.dictionary_table(spark, {"a": ["x", "y"]}).count() == 2
    for ddl in (schemas.MAIL, schemas.REQUIREMENTS, schemas.SHEET, schemas.DEMAND, schemas.SUPPLY, schemas.HISTORY, schemas.MAIL_TYPE):
        assert spark.createDataFrame([], ddl).count() == 0


RAW = {"payload": {"mimeType": "multipart/mixed", "parts": [{"mimeType": "text/html", "body": {"data": "PGI-eDwvYj4"}}, {"mimeType": "text/plain", "body": {"data": "aGk"}}, {"mimeType": "application/pdf", "filename": "s.pdf", "body": {"data": "AA", "size": 1}}]}}


def test_mails_and_documents(spark, tmp_path):
    (tmp_path / "pages.jsonl").write_text('["m1", "m2"]\n["m3", "m4"]\n')
    for name in ("m1", "m3"):
        (tmp_path / f"{name}.json").write_text(json.dumps(RAW))
    spark.dataSource.register(documents.MailSource)
    read = spark.read.format("mails").option("path", str(tmp_path)).option("max", 3).load()
    assert sorted(x["message_id"] for x in read.collect()) == ["m1", "m3"]
    parsed = documents.parse_messages(read).first()
    assert (parsed["plain"], parsed["html"], parsed["attachments"][0]["filename"]) == ("hi", "<b>x</b>", "s.pdf")
    broken = documents.parse_messages(spark.createDataFrame([("{",), (None,)], "raw string")).collect()
    assert all(x["plain"] is None for x in broken)
    data = spark.createDataFrame([(bytearray("日本".encode("cp932")),), (bytearray(b"%PDF-1"),), (None,)], "content binary")
    got = documents.to_text(data, {"pdf": lambda b: "pdf text"}).collect()
    assert [x["text"] for x in got] == ["日本", "pdf text", None]
    assert documents.to_text(data).collect()[1]["error"] == "no parser for pdf"
    good = "line one is long enough\nline two is long enough too"
    tries = spark.createDataFrame([("a", 2, good), ("a", 1, ""), ("b", 1, "short"), ("b", 2, None)], "id string, p int, text string")
    found = {x["id"]: x for x in documents.first_success(tries, "id", "p").collect()}
    assert found["a"]["text"] == good and not found["b"]["success"] and found["b"]["reasons"] == ["short", "empty"]


def test_streams(spark, tmp_path):
    events = pd.DataFrame({"k": ["a", "a", "b"], "ts": pd.to_datetime(["2024-01-01 00:00", "2024-01-01 00:10", "2024-01-01 00:20"])})
    spark.createDataFrame(events).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("k string, ts timestamp").parquet(str(tmp_path / "in"))
    for name, query in (("firsts", mails.first_seen(stream(), ["k"], "ts")), ("counts", mails.windowed_counts(stream(), "k", "ts"))):
        writer = query.writeStream.format("memory").queryName(name).outputMode("append" if name == "firsts" else "complete")
        writer.option("checkpointLocation", str(tmp_path / f"c-{name}")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("firsts").count() == 2 and spark.table("counts").agg(F.sum("n")).first()[0] == 3
    state = history.RunState(spark, str(tmp_path / "state"))
    mails.into_history(stream(), state, ["k"], str(tmp_path / "c-state")).awaitTermination()
    assert {x["k"] for x in state.read("history").collect()} == {"a", "b"}
