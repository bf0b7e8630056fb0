"""Order as data: ordinals of files, numbers on the whole sort key, and ties of any type."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import rows
from millrace.sources import jsonl


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f'{{"k": {k}, "v": "{v}"}}\n' for k, v in lines))


def test_last_wins_over_files_of_any_size(spark, tmp_path):
    write(tmp_path / "d", "a.json", [(1, "old"), (2, "only")])
    write(tmp_path / "d", "b.json", [(1, "x" * 50), *[(9, "y" * 100)] * 300, (1, "new")])
    read = jsonl.read_jsonl(spark, str(tmp_path / "d"), "k long, v string")
    assert {(r["k"], r["v"][:4]) for r in rows.keep_last(read, ["k"], "_ord").collect()} == {(1, "new"), (2, "only"), (9, "yyyy")}


def test_last_wins_over_parts_of_a_file(spark, tmp_path):
    write(tmp_path / "d", "a.json", [(i % 50, f"v{i}") for i in range(5000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = jsonl.read_jsonl(spark, str(tmp_path / "d"), "k long, v string")
        assert read.select("_ord.part").distinct().count() > 5
        assert {(r["k"], r["v"]) for r in rows.keep_last(read, ["k"], "_ord").collect()} == {(k, f"v{4950 + k}") for k in range(50)}
        ordered = rows.numbered(read.drop("k"), [], [F.col("_ord")], group_rows=300)
        assert all(r["v"] == f"v{r['seq'] - 1}" for r in ordered.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("order", ["score DESC NULLS LAST, id", "score NULLS FIRST, name DESC, id", "name DESC NULLS FIRST, id DESC"])
@pytest.mark.parametrize("by", [["band"], []])
def test_numbers_in_ranges_are_those_of_a_window(spark, by, order):
    draw = random.Random(2)
    order = [getattr(F.col(x.split()[0]), ("desc" if "DESC" in x else "asc") + ("_nulls_last" if "LAST" in x else "_nulls_first" if "FIRST" in x else ""))() for x in order.split(", ")]
    data = [(i, draw.choice(["a", "a", "a", None]), draw.choice([0.0] * 18 + [None, draw.random()]), draw.choice(["x", "é", None, ""]), {"m": i}) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, band string, score double, name string, extra map<string,long>").repartition(7)
    wanted = df.withColumn("seq", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    got = rows.numbered(df, by, order, group_rows=60)
    assert got.columns == wanted.columns
    assert {(r["id"], r["seq"]) for r in got.collect()} == {(r["id"], r["seq"]) for r in wanted.collect()}


def test_ties_get_the_same_numbers_on_either_path(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("band"), F.lit(0.0).alias("total")).repartition(5)
    a, b = (rows.numbered(df, ["band"], [F.desc("total")], group_rows=n) for n in (100, 10_000))
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    assert rows.numbered(df.limit(0), ["band"], [F.desc("total")], group_rows=1).count() == 0
    same = spark.range(500).select(F.lit(1).alias("x"))
    assert sorted(r["seq"] for r in rows.numbered(same, [], [F.col("x")], group_rows=10).collect()) == list(range(1, 501))


def test_ties_of_any_type(spark):
    data = [(1, "2024-01-02", "b", 1), (1, "2024-01-02", "a", 2), (1, "2024-01-02", None, 3), (1, None, "a", 4), (None, None, "z", 5), (None, None, "y", 6), (2, "1", None, 7)]
    df = spark.createDataFrame(data, "k long, o string, t string, i long").repartition(3)
    assert {(r["k"], r["i"]) for r in rows.keep_latest(df, ["k"], "o", "t").collect()} == {(1, 2), (None, 6), (2, 7)}
    low = -(1 << 63)
    whole = spark.createDataFrame([(1, "x", low, 1), (1, "x", 5, 2), (1, "x", None, 3)], "k long, o string, t long, i long")
    assert [r["i"] for r in rows.keep_latest(whole, ["k"], "o", "t").collect()] == [1]


def test_counts_while_writing(spark, tmp_path):
    tally = rows.Tally()
    df = spark.range(100)
    tally.watch(df, "in", even=F.col("id") % 2 == 0).write.parquet(str(tmp_path / "in"))
    tally.watch(df.filter("id < 90"), "out").write.parquet(str(tmp_path / "out"))
    assert tally.counts("in") == {"rows": 100, "even": 50}
    assert tally.same("in") == 100
    with pytest.raises(ValueError, match="in 100, out 90"):
        tally.same("in", "out")
    with pytest.raises(ValueError):
        rows.same_count(df, spark.range(3))
    assert rows.same_count(df, spark.range(100)).count() == 100


@pytest.mark.parametrize("by", [["band"], []])
def test_small_ranges_of_many_rows_are_bounded_in_number(spark, monkeypatch, by):
    """As each range costs the driver its samples and a status, however few rows it has."""
    seen, write = [], rows.written
    monkeypatch.setattr(rows, "written", lambda df, label: seen.append(df.rdd.getNumPartitions()) or write(df, label))
    df = spark.range(30_000).select("id", (F.col("id") % 2).alias("band"), (F.col("id") % 10).alias("lead"))
    got = rows.numbered(df, by, [F.desc("lead"), F.col("id")], group_rows=20)
    wanted = df.withColumn("seq", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("lead"), F.col("id"))))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in wanted.collect()} and 2 <= seen[0] <= 500


def result_bytes(spark, run):
    """Bytes of task results, samples of range partitioners among them, that came to the driver while ``run`` ran."""
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm

    def stages():
        found = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(x.stageId(), x.attemptId()): x.resultSize() for x in map(found.apply, range(found.size()))}

    before = stages()
    run()
    return sum(v for k, v in stages().items() if k not in before)


def test_ranges_send_the_driver_little(spark):
    """One sequence over 60,000 rows of 20 a range: 500 ranges' statuses and their samples, not 3,001 ranges'."""
    df = spark.range(60_000).select("id", (F.col("id") % 10).alias("lead"))
    sent = result_bytes(spark, lambda: rows.numbered(df, [], [F.desc("lead"), F.col("id")], group_rows=20).write.format("noop").mode("append").save())
    assert 100_000 < sent < 9_000_000


def test_routed_mails_are_read_once(spark):
    from millrace import queries

    df = queries.QUERIES["mail_type_route"](spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    labels = spark.createDataFrame([("a",), ("b",), (None,), ("q",)], "o string")
    parts = {r["p"]: r["count"] for r in labels.groupBy(rows.part(F.col("o"), ["a", "b"], "unknown").alias("p")).count().collect()}
    assert parts == {k: v.count() for k, v in rows.route(labels, "o", ["a", "b"], "unknown").items()}
