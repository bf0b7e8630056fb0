"""Quantities and stances in the many ways mails put them; texts of our own."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import amounts, classify, packs, prices

CASES = [
    (packs.project_price, "value", [
        ("単価: 70万円", 700_000), ("単価: 60〜70万", 650_000), ("■単価\n65万前後", 650_000), ("単価 : 55 - 65", 600_000), ("予算: 600,000円", 600_000), ("予算: 600,000円〜700,000円", 650_000),
        ("単価: 4,000円/h", 640_000), ("日額: 35,000円", 700_000), ("単価: 3万円/日", 600_000), ("月額: 80万円", 800_000), ("単価: 経験次第", 1_000_000), ("単価: スキル見合い(上限80万)", 800_000),
        ("精算: 140-180h\n年齢: 50歳", None), ("単価:\n期間: 10月〜12月", None), ("電話 03-1234-5678", None), ("単価: 900万", None), ("", None), (None, None),
    ]),
    (packs.resource_price, "value", [("希望単価: 68万", 680_000), ("単価: 65~70万円(税別)", 675_000), ("単価: 相談ください", 1_000_000), ("単価: 相談\n希望 70万", 700_000), ("特になし", None)]),
    (packs.age_limit, "value", [
        ("年齢: 50代前半まで", 54), ("年齢: 40代後半", 100), ("年齢: 〜45歳", 45), ("年齢: 45歳前後", 45), ("年齢制限: なし", 100), ("年齢: 45歳まで\n国籍: 不問", 45), ("若手(30代半ばまで)", 34), ("55歳以上はお断り", 54),
        ("経験3年以上", 100), ("年齢: 30〜40代", 49), ("", 100), (None, 100),
    ]),
    (packs.own_age, "value", [("氏名: T.S (41)", 41), ("T.K (29歳 男性)", 29), ("年齢: 38", 38), ("50代半ば", 55), ("年齢: 99", 1), (None, 1)]),
    (packs.remote, "value", [
        ("リモート: 100%", "fullremote"), ("在宅のみ", "fullremote"), ("原則出社", "onsite"), ("フル常駐", "onsite"), ("テレワーク禁止", "onsite"), ("週3リモート", "hybrid"), ("リモート週4日", "hybrid"), ("基本在宅、月1日出社", "hybrid"),
        ("週5日出社", "onsite"), ("ハイブリッド勤務", "hybrid"), ("リモート開発ツールの経験", "onsite"), (None, "onsite"),
    ]),
    (packs.foreign_ok, "value", [("外国籍の方は今回対象外です", False), ("日本人限定", False), ("国籍: 日本", False), ("外国籍も可", True), ("外国籍: 応相談", True), ("", True)]),
    (packs.freelance_ok, "value", [("個人事業主の方は不可", False), ("プロパー限定", False), ("フリーランス歓迎", True), ("個人情報は不可", True)]),
    (packs.nationality, "value", [("国籍不問", "japanese"), ("国籍: 韓国", "foreign"), ("国籍 ベトナム", "foreign"), ("【国籍】日本", "japanese"), ("インド出身", "foreign"), ("中国人気サイトの開発", "japanese"), ("日本語: N2", "foreign")]),
    (packs.employment, "value", [("所属: フリーランス", "freelance"), ("弊社プロパー", "employee"), ("個人事業主の方です", "freelance"), ("個人情報の扱い", "employee")]),
    (packs.contract, "value", [("契約形態: 派遣", "dispatch"), ("準委任または派遣", "quasi_mandate"), ("派遣事業許可番号: 派13-1", "outsourcing"), ("有料職業紹介事業 派遣契約", "outsourcing")]),
]


@pytest.mark.parametrize("extract, field, cases", CASES, ids=lambda x: getattr(x, "__name__", None))
def test_extractors(spark, extract, field, cases):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["v"] for r in df.select("i", extract(F.col("t"))[field].alias("v")).collect()}
    assert {cases[i][0]: v for i, v in got.items()} == dict(cases)


def test_workloads_and_flows(spark):
    cases = [
        (lambda x: packs.workload(x)["min"], "稼働率 50%〜80%", 50), (lambda x: packs.workload(x)["max"], "単価10%UP、稼働: 60%", 60), (lambda x: packs.workload(x)["min"], "消費税10%", 100),
        (lambda x: packs.own_workload(x)["max"], "週2〜3日", 60), (lambda x: packs.own_workload(x)["max"], "週3日から", 100), (lambda x: packs.own_workload(x)["min"], "週2日出社", 100), (lambda x: packs.own_workload(x)["min"], "副業で参画", 20),
        (packs.flow_level, "商流: 不問", 0), (packs.flow_level, "商流制限: 貴社1社下まで", 2), (packs.flow_level, "貴社プロパーのみ", 1),
        (lambda x: packs.vendor_flow(x, F.lit("A@Own.example"), "own.example"), "二次請け", 12), (lambda x: packs.vendor_flow(x, F.lit(None), "own.example"), "BPの要員", 21),
    ]
    for extract, said, value in cases:
        assert spark.range(1).select(extract(F.lit(said)).alias("v")).first()["v"] == value, said


def test_spans_are_read_once_each(spark):
    found = spark.range(1).select(amounts.spans(F.lit("日給 2万〜2.5万円/日、30代前半まで、1,200円以上はNG")).alias("s")).first()["s"]
    assert [(s["raw"].strip(), float(s["first"]), s["unit"], s["second_unit"], s["limit"], s["refused"]) for s in found] == [
        ("日給 2万〜2.5万円/日", 2.0, "万", "万円", "", ""), ("30代前半まで", 30.0, "代", "", "まで", ""), ("1,200円以上はNG", 1200.0, "円", "", "以上", "NG"),
    ]


def test_dampings_are_data(spark):
    rule = (classify.Damping(("a",), 0.5, 2, side="supply", above=1.0), classify.Damping(("a",), 0.1, pattern="x"), classify.Damping(("b",), 3.0))
    score = lambda text, level: spark.range(1).select(classify.word_scores(F.lit(text), {"a": 1.0, "b": 2.0, "c": 1.0}, rule, {"supply": F.lit(level)}).alias("v")).first()["v"]
    assert score("aaa b c", 2.0) == 1.0 + 6.0 + 1.0
    assert score("aaa x", 0.0) == pytest.approx(0.3)
    assert score("aaa", 1.0) == 3.0


def test_reasons_name_the_kind(spark):
    told = spark.createDataFrame([("単価: 3万円/日",), ("単価: 40-50",), ("x",)], "t string").select(packs.project_price(F.col("t"), F.lit("月額70万円の案件")).alias("p")).collect()
    assert [(r["p"]["reason"], r["p"]["min"], r["p"]["source"]) for r in told] == [("day-man", None, "extracted"), ("bare", 400_000, "extracted"), ("subject-month-man", None, "extracted")]
    assert prices.BY_SKILL == 1_000_000
