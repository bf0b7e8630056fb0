"""From raw mails to drafts over two rounds, each request asked once."""

import os
import time

from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import fields, judge
from millrace.operators.history import RunState
from millrace.plans import matching, rounds

from test_matching import CONFIG, DEMAND, MAILS, SUPPLY, mail


def test_two_rounds(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    folder = str(calls)

    def noted(skills, text):
        with open(os.path.join(folder, f"{time.monotonic_ns()}-{os.getpid()}"), "w") as f:
            f.write("|".join(skills))
        return judge.keyword_judge(skills, text)

    def doubting(skills, text):
        return [{"skill": s, "recheck_match": "not_confirmed" if s == "Oracle" else "confirmed", "note": "n"} for s in skills]

    state = RunState(spark, str(tmp_path / "state"))
    how = rounds.Round(keywords=["Java", "Oracle", "Python"], call=noted, recheck=doubting, store=judge.Store(spark, str(tmp_path / "store"), tasks=2))
    first = rounds.run(spark.createDataFrame(MAILS, schemas.MAIL), CONFIG, how, state, "r1")
    got = {r["supply_id"]: r for r in first["prepared"].collect()}
    assert {k: (r["band"], r["recheck_status"], r["tier"]) for k, r in got.items()} == {"s1": ("match_40_59", None, "judged"), "s8": ("match_40_59", "not_confirmed", "judged")}
    assert [r["match"] for r in got["s8"]["results"]] == [True, False] and sorted(r["seq"] for r in got.values()) == [1, 2]
    assert got["s1"]["proposal"]["proposal_id"] == "r1_d1_s1" and got["s1"]["plan"]["target"] == 180_000
    assert "demand_without_body" not in got["s1"]["notes"] and got["s1"]["needs_review"] == bool(got["s1"]["notes"])
    drafts = {(r["supply_id"], r["mode"]): r for r in first["drafts"].collect()}
    assert set(drafts) == {(s, m) for s in ("s1", "s8") for m in ("to_demand", "to_supply")}
    offer = drafts["s1", "to_demand"]
    assert offer["to"] == "buyer@b.example" and offer["draft_subject"].startswith("Re: ") and "price: 78万円" in offer["body"] and "- [o] Java" in offer["body"] and "- [x] Oracle" in offer["body"]
    assert offer["body"].index("[supply]") < offer["body"].index("----- quoted -----") < offer["body"].index("必須スキル")
    assert "remote: onsite" in drafts["s1", "to_supply"]["body"] and drafts["s1", "to_supply"]["to"] == "s@s.example"
    asked = len(list(calls.iterdir()))
    assert asked == 2 and first["errors"].count() == 0

    more = [*MAILS, mail("s9", "s9@s.example", "要員9", SUPPLY + "\nOracle 経験")]
    second = rounds.run(spark.createDataFrame(more, schemas.MAIL), CONFIG, how, state, "r2")
    assert {r["supply_id"]: r["tier"] for r in second["prepared"].collect()} == {"s1": "exact", "s8": "exact", "s9": "judged"}
    assert len(list(calls.iterdir())) == asked + 1
    assert state.latest() == 2 and state.read("cache").count() == 3 and state.read("history").count() == 3


def test_keywords_by_spans(spark):
    df = spark.createDataFrame([(["JavaScriptの経験", "AWS S3, javaScript", "雑談 Go"],), (["Java 3年以上"],), (None,)], "s array<string>")
    terms = ["Java", "JavaScript", "S3", "AWS", "Go", "C++", ".NET"]
    got = [r["k"] for r in df.select(fields.keywords(F.col("s"), terms, "雑談", ["Java"]).alias("k")).collect()]
    assert got == [["JavaScript", "AWS", "S3"], ["3年以上", "Java"], []]
    phased = df.select(fields.keywords(F.col("s"), ["AWS"], phases=["経験"], extra="S[0-9]").alias("k")).first()["k"]
    assert phased == ["AWS", "経験", "S3"]
    assert df.select(fields.keyword_spans(F.col("s"), []).alias("k")).first()["k"] == []


def test_evidence_decides(spark):
    demand = spark.createDataFrame([("d1", ["Java 5年"], "x"), ("d2", ["SQL"], "x"), ("d3", [], "x")], "demand_id string, required_skills array<string>, demand_body string")
    supply = spark.createDataFrame([("s1", "Java と SQL"), ("s2", "PHP"), ("s3", None)], "supply_id string, skillsheet string")
    found = demand.select("demand_id").crossJoin(supply.select("supply_id")).withColumn("p_phases", F.array().cast("array<string>"))
    how = rounds.Round(keywords=["Java", "SQL"], noise=[("SQL", "needs a database", F.contains("skillsheet", F.lit("Oracle")))])
    config = matching.Config(skills={}, phases={}, regions={}, strong_phases=())
    kept = {(r["demand_id"], r["supply_id"]): r["hits"] for r in rounds.evidenced(found, demand, supply, config, how).collect()}
    assert kept == {("d1", "s1"): ["Java"], **{("d3", s): [] for s in ("s1", "s2", "s3")}}
    assert DEMAND
