"""State as a log: what counts, what a crash leaves, and how much is written."""

import os

import pytest

from millrace.operators.history import RunState
from millrace.streaming import mails


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def pairs(spark, low, high):
    return spark.range(low, high).selectExpr("id AS a", "id % 7 AS b")


def test_appends_write_what_is_new(spark, tmp_path):
    state = RunState(spark, str(tmp_path), compact_after=100)
    state.append(pairs(spark, 0, 50_000), pairs(spark, 0, 50_000))
    before = size(tmp_path / "parts")
    for i in range(4):
        state.append(pairs(spark, 50_000 + i, 50_001 + i), pairs(spark, 50_000 + i, 50_001 + i), tag=i)
    assert size(tmp_path / "parts") - before < before / 10
    assert state.read("history").count() == state.read("cache").count() == 50_004
    assert state.append(pairs(spark, 0, 9), pairs(spark, 0, 9), tag=3) is None and state.latest_tag() == 3


def test_a_run_without_its_log_entry_counts_for_nothing(spark, tmp_path, monkeypatch):
    state = RunState(spark, str(tmp_path))
    state.commit(pairs(spark, 0, 3), pairs(spark, 0, 3), spark.range(0))
    with monkeypatch.context() as m:
        m.setattr(RunState, "LOG", "no such schema")
        with pytest.raises(Exception):
            state._write({"history": pairs(spark, 0, 9)}, True, 1)
    real = spark.createDataFrame
    with monkeypatch.context() as m:  # lost between the parts and the log
        m.setattr(type(spark), "createDataFrame", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            state.append(pairs(spark, 3, 5), pairs(spark, 3, 5), tag=1)
    assert len(os.listdir(tmp_path / "parts")) > 2 and state.read("history").count() == 3 and state.latest_tag() is None
    assert state.append(pairs(spark, 3, 5), pairs(spark, 3, 5), tag=1) == 2
    assert state.read("history").count() == state.read("cache").count() == 5 and real


def test_bases_replace_and_errors_keep_the_cache(spark, tmp_path):
    state = RunState(spark, str(tmp_path), compact_after=3)
    assert state.latest() is None and state.read("history") is None
    state.commit(pairs(spark, 0, 3), pairs(spark, 0, 3), spark.range(0))
    state.commit(pairs(spark, 5, 6), pairs(spark, 5, 6), spark.range(1))
    assert state.read("history").count() == 1 and state.read("cache").count() == 3
    for i in range(5):
        state.append(pairs(spark, 10 + i, 11 + i), pairs(spark, 10 + i, 11 + i))
    assert len(state.parts("history")) <= 3 and state.read("history").count() == 6 and state.read("cache").count() == 8


def test_stream_into_the_log(spark, tmp_path):
    state = RunState(spark, str(tmp_path / "state"))
    source = str(tmp_path / "in")
    for low in (0, 3):
        pairs(spark, low, low + 5).write.mode("append").parquet(source)
        stream = spark.readStream.schema("a long, b long").parquet(source)
        mails.into_history(stream, state, ["a"], str(tmp_path / "check")).awaitTermination()
    assert sorted(r["a"] for r in state.read("history").collect()) == list(range(8)) == sorted(r["a"] for r in state.read("cache").collect())


def test_judged_rows_are_answered_in_small_parts(monkeypatch):
    """What one call of the worker's function holds is bounded in skills, whatever the batch has; one large row comes alone."""
    import pandas as pd

    from millrace.operators import judge
    from millrace.storage import shares, sliced

    skills, texts = pd.Series([["a"] * n for n in (3, 4000, 2000, 9000, 1, 1)] + [None, ["b"]]), pd.Series(["t"] * 6 + [None, "x" * 4_999_000])
    parts = list(sliced(iter([(skills, texts), (skills[:1], texts[:1])]), judge._weight, judge.ANSWERS))
    assert [len(a) for a, _ in parts] == [2, 1, 1, 3, 1, 1] and pd.concat([b for _, b in parts[:5]]).equals(texts)
    assert list(shares([], 5)) == [] and list(shares([9, 9], 5)) == [slice(0, 1), slice(1, 2)]


def test_judged_over_many_parts(spark, monkeypatch):
    from pyspark.sql import functions as F

    from millrace.operators import judge

    df = spark.range(3000).select("id", F.transform(F.sequence(F.lit(1), F.lit(20)), lambda x: x.cast("string")).alias("required_skills"), F.concat(F.lit("1 2 "), F.col("id").cast("string")).alias("skillsheet"))
    got = judge.judged(df.coalesce(1)).select("id", "skillsheet", F.filter("results", lambda r: r["match"])["skill"].alias("met")).collect()
    assert len(got) == 3000 and all(set(r["met"]) == {str(x) for x in range(1, 21) if str(x) in r["skillsheet"]} for r in got)


def test_answers_do_not_pile_up_in_a_worker(spark):
    """3,000 rows of 20 skills in one batch: the worker has the answers of two slices of 5,000 skills, that it makes and that before it."""
    from pyspark.sql import functions as F

    from millrace.operators import judge

    def told(skills, text):
        import builtins

        alive = builtins.__dict__.setdefault("_alive", [0])  # of this worker

        class Answer(list):
            def __del__(self):
                alive[0] -= 1

        alive[0] += 1
        return Answer({"skill": s, "match": True, "note": str(alive[0])} for s in skills)

    df = spark.range(3000).select("id", F.transform(F.sequence(F.lit(1), F.lit(20)), lambda x: x.cast("string")).alias("required_skills"), F.lit("x").alias("skillsheet"))
    got = judge.judged(df.coalesce(1), told).select(F.col("results")[0]["note"].cast("int").alias("alive"), "error").collect()
    assert len(got) == 3000 and all(r["error"] is None for r in got) and max(r["alive"] for r in got) <= 500


def test_normal_forms_in_slices(spark, monkeypatch):
    """Batches of few MB reach the worker, which has one slice of them at a time; nulls and empty texts stay."""
    from pyspark.sql import functions as F

    from millrace import queries
    from millrace.functions import text
    from millrace.storage import BATCH, BATCH_BYTES

    df = spark.createDataFrame([(None,), ("",), ("\uff21\u338f",), ("x" * 3_000_000 + "\uff21",), (None,)], "t string").coalesce(1)
    assert [r["n"] for r in df.select(text.nfkc(F.col("t")).alias("n")).collect()] == [None, "", "Akg", "x" * 3_000_000 + "A", None]
    monkeypatch.setattr(text, "SLICE", 3, raising=False)
    assert [r["n"] for r in df.limit(3).select(text.nfkc(F.col("t")).alias("n")).collect()] == [None, "", "Akg"]
    old = spark.conf.get(BATCH)
    spark.conf.set(BATCH, "67108864b")
    queries.QUERIES["nfkc_normalise"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get(BATCH) == str(BATCH_BYTES)
    spark.conf.set(BATCH, old)
