"""Files for rows, and judges that are asked once."""

import os
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import judge, render
from millrace.sources.text_files import write_files


def files(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f)).read() for d, _, names in os.walk(folder) for f in names if not f.startswith((".", "_"))}


def test_a_file_for_each_row(spark, tmp_path):
    df = spark.range(20).select(F.concat(F.lit("band_"), F.col("id") % 2).alias("band"), "id", F.when(F.col("id") != 3, F.concat(F.lit("é"), "id")).alias("t")).repartition(3)
    name = F.concat("band", F.lit("/"), render.sequence_name(F.col("id"), "pair_"), F.lit(".txt"))
    write_files(df, str(tmp_path), name, F.col("t"))
    assert files(tmp_path) == {f"band_{i % 2}/pair_{i:04d}.txt": f"é{i}" if i != 3 else "" for i in range(20)}
    assert not [x for x in os.listdir(tmp_path) if x.startswith("_staging")]
    with pytest.raises(Exception, match="one name"):
        write_files(df, str(tmp_path / "twice"), F.lit("x.txt"), F.col("t"))
    assert files(tmp_path / "twice") == {}


def test_a_task_that_fails_leaves_no_file(spark, tmp_path):
    bad = spark.range(40).select(F.concat(F.lit("f"), "id").alias("n"), F.when(F.col("id") == 37, F.raise_error(F.lit("lost"))).otherwise(F.repeat(F.lit("x"), 9999)).alias("t")).repartition(4)
    with pytest.raises(Exception, match="lost"):
        write_files(bad, str(tmp_path / "out"), F.col("n"), F.col("t"))
    assert files(tmp_path / "out") == {} and not [d for d, _, _ in os.walk(tmp_path / "out") if "_staging" in d]


def test_each_request_is_asked_once(spark, tmp_path, monkeypatch):
    calls, path = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()
    store = judge.Store(spark, path, tasks=2)
    rows = [(i, ["Java"], f"Java {i % 5}") for i in range(40)] + [(40, ["Java"], "no"), (41, None, "x"), (42, ["Go"], " ")]
    pairs = spark.createDataFrame(rows, "id long, required_skills array<string>, skillsheet string").repartition(4)
    lost = os.path.join(path, "lost")

    folder = str(calls)

    def noted(skills, text):  # a file for each call
        with open(os.path.join(folder, f"{time.monotonic_ns()}-{os.getpid()}"), "w") as f:
            f.write(text)
        if text == "no":
            raise judge.Refused("no")
        return judge.keyword_judge(skills, text)

    def fails_late(skills, text):  # the task is lost behind a call: what it was told before must count
        answer = noted(skills, text)
        if text == "Java 3" and not os.path.exists(lost):
            open(lost, "w").close()
            raise SystemExit("lost")
        return answer

    with pytest.raises(Exception):
        judge.judged(pairs, fails_late, store=store).collect()
    found = {r["id"]: r for r in judge.judged(pairs, fails_late, store=store).collect()}
    said = [p.read_text() for p in calls.iterdir()]
    assert sorted(set(said)) == ["Java 0", "Java 1", "Java 2", "Java 3", "Java 4", "no"]
    assert len(said) - said.count("no") <= 6  # the call that was lost is the only one asked again
    assert all(found[i]["results"][0]["match"] for i in range(40)) and found[40]["error"] == "llm_call_error" and "Refused" in found[40]["cause"]
    assert (found[41]["error"], found[42]["error"]) == ("missing_project_required_skills", "missing_resource_skillsheet")
    before = len(said)
    again = judge.judged(pairs.filter("id < 40"), noted, store=judge.Store(spark, path)).collect()
    assert len(list(calls.iterdir())) == before and all(r["results"][0]["match"] for r in again)


def test_rechecks_through_the_store(spark, tmp_path):
    store = judge.Store(spark, str(tmp_path / "store"))
    pairs = judge.judged(spark.createDataFrame([(1, ["Java", "Go"], "Java"), (2, ["Go"], "x")], "id long, required_skills array<string>, skillsheet string"))
    agree = lambda skills, text: [{"skill": s, "recheck_match": "confirmed", "note": "n"} for s in skills]
    got = {r["id"]: r for r in judge.recheck(pairs, agree, store=store).collect()}
    plain = {r["id"]: r for r in judge.recheck(pairs, agree).collect()}
    assert {k: (r["recheck_status"], [c["skill"] for c in r["checks"]]) for k, r in got.items()} == {1: ("confirmed", ["Java"]), 2: ("confirmed", [])} == {k: (r["recheck_status"], [c["skill"] for c in r["checks"]]) for k, r in plain.items()}


def test_calls_have_a_time_limit_and_a_rate(spark, tmp_path):
    slow = judge.Patient(lambda skills, text: time.sleep(5), spacing=0, tries=1, wait=0, timeout=0.1)
    with pytest.raises(TimeoutError):
        slow(["a"], "b")
    store = judge.Store(spark, str(tmp_path / "s"), tasks=2, rate=10.0)
    pairs = spark.createDataFrame([(["a"], f"t{i}") for i in range(8)], "required_skills array<string>, skillsheet string")
    began = time.monotonic()
    assert judge.judged(pairs, store=store).count() == 8
    assert time.monotonic() - began >= 0.4  # of eight calls one task has four at least, 0.2 s apart
