import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.operators.ranking import chronological, lagged, latest_per_key, ranked, top_k_per_key


def test_rank_matches_sorting_with_a_hot_group(spark):
    rng = random.Random(3)
    rows = [(("hot" if i % 3 else f"g{i % 7}"), rng.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, id long").repartition(9)
    got = ranked(df, [F.col("v").desc(), F.col("id").asc()], "n", ["g"])
    want = {}
    for g in {r[0] for r in rows}:
        for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            want[r[2]] = n
    assert {r.id: r.n for r in got.collect()} == want


def test_global_rank_and_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v int")
    assert {(r.v, r.n) for r in ranked(df, [F.col("v").asc()], "n").collect()} == {(1, 1), (2, 2), (3, 3)}
    by = ranked(df, [F.col("v").asc()], "n", ["g"]).collect()
    assert {(r.g, r.v, r.n) for r in by} == {(None, 1, 1), (None, 3, 2), ("a", 2, 1)}


def test_rank_of_nothing(spark):
    assert ranked(spark.createDataFrame([], "g string, v int"), [F.col("v").asc()], "n", ["g"]).count() == 0


def test_sort_of_the_rank_is_distributed(spark):
    df = spark.range(0, 20000, 1, 8).withColumn("g", F.lit(1))
    out = ranked(df, [F.col("id").desc()], "n", ["g"])
    assert out.select(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 20000, 20000)


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, t int, v string")
    out = latest_per_key(df, ["k"], ["t"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {(r.k, r.v) for r in out.collect()} == {(1, "b"), (2, "c")}


def test_top_k_and_sequence(spark):
    df = spark.createDataFrame([("x", i, f"e{i}") for i in (5, 3, 9, 1)], "who string, at int, e string")
    assert [r.e for r in chronological(df, ["who"], [F.col("at").asc()]).orderBy("step").collect()] == ["e1", "e3", "e5", "e9"]
    top = top_k_per_key(df, ["who"], [F.col("at").desc()], 2).collect()
    assert {(r.e, r["rank"]) for r in top} == {("e9", 1), ("e5", 2)}


def test_lagged_equals_a_window_without_putting_a_group_in_one_task(spark):
    rows = spark.range(200).selectExpr("id", "nullif(id % 3, 2) as g", "id * 37 % 200 as o", "nullif(id % 5, 0) as v")
    window = W.partitionBy("g").orderBy("o")
    want = rows.select("id", F.lag("v").over(window).alias("before"), F.lag("o").over(window).alias("place"))
    got = lagged(rows, [F.col("o").asc()], {"before": "v", "place": "o"}, ["g"]).select("id", "before", "place")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    whole = lagged(rows, [F.col("o").asc()], {"before": "v"})
    assert sorted(map(str, whole.select("id", "before").collect())) == sorted(
        map(str, rows.select("id", F.lag("v").over(W.orderBy("o")).alias("before")).collect()))
    assert "SinglePartition" not in whole._jdf.queryExecution().executedPlan().toString()
    assert lagged(rows.limit(0), [F.col("o").asc()], {"before": "v"}).count() == 0
