"""Range and interval joins against all pairs, on both paths, and their plans."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import queries
from millrace.operators import pairs

DIR = "/root/testdata/sf0.001"


def rows(draw, n, at, hot):
    value = lambda: None if draw.random() < 0.05 else 7 if draw.random() < hot else draw.randrange(40)
    return [(at + i, value(), value()) for i in range(n)] + [(at, 7, 9)] * 3


@pytest.mark.parametrize("bound", [100_000, 40])
@pytest.mark.parametrize("bounds", [[("a", ">=", "x")], [("a", "<=", "y"), ("b", ">=", "x")]])
def test_ranged_finds_the_pairs_of_the_product(spark, monkeypatch, bound, bounds):
    monkeypatch.setattr(pairs, "BROADCAST_ROWS", bound)
    draw = random.Random(4)
    demand = spark.createDataFrame(rows(draw, 90, 0, 0.1), "d long, a long, b long")
    supply = spark.createDataFrame(rows(draw, 140, 1000, 0.7), "s long, x long, y long")
    met = pairs._either_null(*[F.col(c) for b in bounds for c in b[::2]])
    holds = F.lit(True)
    for left, op, right in bounds:
        holds = holds & (F.col(left) >= F.col(right) if op == ">=" else F.col(left) <= F.col(right))
    wanted = sorted(tuple(r) for r in demand.crossJoin(supply).filter(met | F.coalesce(holds, F.lit(False))).select("d", "s").collect())
    found = pairs.ranged(demand, supply, bounds, blocks=8)
    assert sorted(tuple(r) for r in found.select("d", "s").collect()) == wanted
    assert found.columns == [*demand.columns, *supply.columns]
    assert pairs.ranged(demand, supply.limit(0), bounds).count() == 0 and pairs.ranged(demand.limit(0), supply, bounds).count() == 0
    nulls = supply.withColumns({"x": F.lit(None).cast("long"), "y": F.lit(None).cast("long")})
    assert pairs.ranged(demand, nulls, bounds).count() == 93 * 143
    with pytest.raises(ValueError):
        pairs.ranged(demand, supply, [("a", "=", "x")])


def test_pairs_by_values(spark):
    demand = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "d long, p string")
    supply = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "s long, r string")
    met = F.col("p").isNull() | F.coalesce(F.col("p") == F.col("r"), F.lit(False))
    assert {tuple(r) for r in pairs.by_values(demand, supply, ["p"], ["r"], met).select("d", "s").collect()} == {(1, 1), (3, 1), (2, 1), (2, 2), (2, 3)}
    counts = pairs.pair_counts(demand.drop("d"), supply.drop("s"), met, ["p"])
    assert {tuple(r) for r in counts.collect()} == {("a", 2), (None, 3)}


def test_a_side_of_few_large_rows_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BROADCAST_BYTES", 10_000)
    assert pairs.small(spark.range(50)) and not pairs.small(spark.range(50).select(F.repeat(F.lit("x"), F.lit(1000)).alias("sheet")))


@pytest.mark.parametrize("name", ["pair_budget", "pair_age", "pair_interval_overlap"])
def test_plans_have_no_nested_loop(spark, name):
    plan = queries.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "HashJoin" in plan or "SortMergeJoin" in plan


def most_rows(df):
    """Run ``df``; the most rows that an operator of its plan gave."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan()
    found, todo = [0], [text]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        metric = node.metrics().get("numOutputRows")
        found += [metric.get().value()] if metric.isDefined() else []
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return max(found)


@pytest.fixture
def users(spark):
    """300 users with sets of few kinds: some empty, some without a strong phase, some null."""
    kinds = [["signup"], ["view", "signup"], ["signup", "view"], ["view"], [], None, ["purchase", "x"], ["click", "y"]]
    return spark.createDataFrame([(i, kinds[i % len(kinds)]) for i in range(300)], "l long, a array<string>")


def test_phases_are_counted_by_kinds(spark, users):
    strong = ["purchase", "signup"]
    a, b = users.withColumn("a", pairs.seen_phases(F.col("a"), strong)), users.select(pairs.seen_phases(F.col("a"), strong).alias("b"))
    found = pairs.partners(a, b, ["a"], ["b"], pairs.phases(F.col("a"), F.col("b"), strong)).select("l", "n")
    wanted = users.join(users.select(F.col("a").alias("b")), pairs.phases(F.col("a"), F.col("b"), strong)).groupBy("l").agg(F.count("*").alias("n"))
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in wanted.collect()} and found.count() == 300
    assert most_rows(wanted) > 10_000 and most_rows(found) <= 300


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """Tables 20 times as large by copies, which have 400 times the pairs, and the rows of them all."""
    path, n = tmp_path_factory.mktemp("copies"), 0
    for table, key in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"), ("events", "user_id")):
        df = spark.read.parquet(f"{DIR}/{table}.parquet").withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(19))))
        df.withColumn(key, F.col(key) + F.col("_i") * 1_000_000).drop("_i").coalesce(1).write.parquet(f"{path}/{table}.parquet")
        n += spark.read.parquet(f"{path}/{table}.parquet").count()
    return str(path), n


COUNTED = ["pair_phase_overlap", "pair_skill_overlap", "pair_budget", "pair_cascade_audit", "pair_interval_overlap", "pair_location", "pair_tier", "pair_cross_count", "pair_skill_overlap_indexed"]


@pytest.mark.parametrize("name", COUNTED)
def test_queries_make_no_pairs_of_rows(spark, copies, name):
    assert most_rows(queries.QUERIES[name](spark, copies[0])) <= copies[1]


def test_a_product_of_one_file_is_spread(spark, tmp_path, monkeypatch):
    spark.range(1000).select(F.col("id").alias("d")).coalesce(1).write.parquet(f"{tmp_path}/d")
    demand, supply = spark.read.parquet(f"{tmp_path}/d"), spark.range(50).select(F.col("id").alias("s"))
    monkeypatch.setattr(pairs, "TASK_PAIRS", 5000, raising=False)
    for a, b in ((demand, supply), (supply, demand)):
        tasks = pairs.product(a, b).groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) >= 10 and sum(r["count"] for r in tasks) == 50_000 and max(r["count"] for r in tasks) <= 10_000
    monkeypatch.setattr(pairs, "BROADCAST_ROWS", 40)
    monkeypatch.setattr(pairs, "CELL_ROWS", 20, raising=False)
    tasks = pairs.product(demand, supply).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 50_000 and max(r["count"] for r in tasks) <= 5000


@pytest.mark.parametrize("op", [">=", "<="])
@pytest.mark.parametrize("left,right", [(["g"], ["h"]), (["g"], []), ([], ["h"]), ([], [])])
def test_range_counts_are_those_of_the_product(spark, op, left, right):
    draw = random.Random(5)
    demand = spark.createDataFrame([(a, draw.choice(["x", None, "z"])) for _, a, _ in rows(draw, 200, 0, 0.3)], "a long, g string").withColumn("a", F.col("a").cast("double"))
    supply = spark.createDataFrame([(x, draw.choice([1, 2, None])) for _, x, _ in rows(draw, 90, 0, 0.3)], "x long, h int")
    met = pairs._either_null(F.col("a"), F.col("x")) | F.coalesce(F.col("a") >= F.col("x") if op == ">=" else F.col("a") <= F.col("x"), F.lit(False))
    wanted = demand.crossJoin(supply).groupBy(*left, *right).agg(F.count_if(met).alias("n_met"), F.count("*").alias("n_all"))
    for blocks in (2, 8, 128):
        found = pairs.range_counts(demand, supply, ("a", op, "x"), left, right, blocks)
        assert found.columns == wanted.columns and {tuple(r) for r in found.collect()} == {tuple(r) for r in wanted.collect()}
    nulls = supply.withColumn("x", F.lit(None).cast("long"))
    assert sum(r["n_met"] for r in pairs.range_counts(demand, nulls, ("a", op, "x"), left, right).collect()) == 203 * 93
    assert sum(r["n_met"] for r in pairs.range_counts(demand.limit(0), supply, ("a", op, "x"), left, right).collect()) == 0


@pytest.mark.parametrize("bound", [100_000, 40])
def test_pairs_by_values_in_many_tasks(spark, monkeypatch, bound):
    monkeypatch.setattr(pairs, "BROADCAST_ROWS", bound)
    monkeypatch.setattr(pairs, "TASK_PAIRS", 500, raising=False)
    draw = random.Random(6)
    demand = spark.createDataFrame(rows(draw, 90, 0, 0.5), "d long, a long, b long")
    supply = spark.createDataFrame(rows(draw, 140, 1000, 0.7), "s long, x long, y long")
    few, rest = F.col("a").isNull() | F.coalesce(F.col("x") >= F.col("a"), F.lit(False)), F.coalesce(F.col("b") <= F.col("y"), F.lit(True))
    found = pairs.by_values(demand, supply, ["a"], ["x"], few, rest)
    assert found.columns == [*demand.columns, *supply.columns]
    got = found.select("d", "s", F.spark_partition_id().alias("task")).collect()
    assert sorted((r["d"], r["s"]) for r in got) == sorted(tuple(r) for r in demand.crossJoin(supply).filter(few & rest).select("d", "s").collect())
    assert len({r["task"] for r in got}) > 4


def test_shared_items_are_counted_by_sets(spark, users):
    left, right = ("l", F.col("a")), ("l", F.col("a"))
    wanted = pairs.sharing(users, users, left, right).groupBy("left").agg(F.count("*").alias("n"))
    found = pairs.sharing_counts(users, users, left, right)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in wanted.collect()}
    assert most_rows(wanted) > 10_000 and most_rows(found) <= 300
