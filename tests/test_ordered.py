import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from innsight.operators import ordered


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows."""
    rnd = random.Random(1)
    data = [(0 if rnd.random() < 0.7 else rnd.randint(1, 5), i, rnd.randint(0, 400)) for i in range(600)]
    df = spark.createDataFrame(data, "k int, id int, d int")
    return df.withColumn("t", F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")))


@pytest.mark.parametrize("step,shift", [(-1, F.lag), (1, F.lead)])
def test_neighbour_equals_one_window(skewed, step, shift):
    got = ordered.neighbour(skewed, ["k"], ["t", "id"], ["id"], F.date_trunc("month", "t").cast("date"), step).select("id", "_neighbour.id")
    want = skewed.select("id", shift("id").over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows_of(got) == rows_of(want)


def test_asof_join_equals_brute_force(spark, skewed):
    right = skewed.where("id % 4 = 0").groupBy("k", F.col("t").alias("since")).agg(F.max("id").alias("value"))
    got = ordered.asof_join(skewed.select("k", "id", "t"), right, ["k"], "t", "since", ["value"])
    rights = [tuple(r) for r in right.collect()]
    want = []
    for r in skewed.collect():
        hits = [(s, v) for k, s, v in rights if k == r.k and s <= r.t]
        want.append((r.id, max(hits)[1] if hits else None))
    assert rows_of(got.select("id", "value")) == sorted(want, key=str)


def test_asof_join_without_right_rows(spark, skewed):
    right = skewed.select("k", F.col("t").alias("since"), F.col("id").alias("value")).limit(0)
    got = ordered.asof_join(skewed.select("k", "id", "t"), right, ["k"], "t", "since", ["value"])
    assert got.count() == 600 and got.where("value IS NOT NULL").count() == 0


@pytest.fixture
def as_many_ranges(spark):
    """Keep small ranges apart, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_instant_of_a_hot_key_spreads_over_ranges(spark, as_many_ranges):
    # Half of all rows are one key's, and most of those fall on one day.
    left = spark.range(20_000).selectExpr("id", "IF(id % 2 = 0, 0, id % 500) AS k", "DATE_ADD(DATE'2000-01-01', CAST(IF(id % 8 < 6, 100, id % 300) AS INT)) AS t")
    right = spark.range(0, 400).selectExpr("id % 20 AS k", "DATE_ADD(DATE'2000-01-01', CAST(id * 7 % 300 AS INT)) AS since", "id AS value").groupBy("k", "since").agg(F.max("value").alias("value"))
    rows = ordered.swept(left, ["k"], "t", [(right, "since", ["value"])])
    sizes = [r["count"] for r in rows.groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / 4
    assert rows.where("k = 0 AND _side = 1").select("_range").distinct().count() >= 2
    got = ordered.asof_join(left, right, ["k"], "t", "since", ["value"])
    rights = {}
    for k, since, value in right.collect():
        rights.setdefault(k, []).append((since, value))
    want = [(r.id, *max((h for h in rights.get(r.k, []) if h[0] <= r.t), default=(None, None))) for r in left.collect()]
    assert rows_of(got.select("id", "since", "value")) == sorted(want, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sum(line.strip(" +-:").startswith("Exchange") for line in plan.split("\n")) <= 3


def test_several_tables_in_one_sweep(spark, skewed, as_many_ranges):
    first = skewed.where("id % 4 = 0").groupBy("k", F.col("t").alias("since")).agg(F.max("id").alias("value"))
    second = skewed.where("id % 9 = 0").groupBy("k", F.col("t").alias("t")).agg(F.min("id").alias("value"), F.max("id").alias("other"))
    odd = spark.createDataFrame([(None, 9001, "2000-05-01"), (1, 9002, None)], "k int, id int, t string").withColumn("t", F.col("t").cast("date"))
    left = skewed.select("k", "id", "t").unionByName(odd).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    got = ordered.asof_sweep(left, ["k"], "t", [(first, "since", ["value"]), (second, "t", ["value", "other"])])
    assert got.columns == ["k", "id", "t", "m", "since", "value", "t_asof", "value_asof", "other"]
    firsts, seconds = [tuple(r) for r in first.collect()], [tuple(r) for r in second.collect()]
    newest = lambda rows, r: max((x[1:] for x in rows if x[0] == r.k and r.t is not None and x[1] <= r.t), default=None)
    want = [(r.id, *(newest(firsts, r) or (None, None)), *(newest(seconds, r) or (None, None, None))) for r in left.collect()]
    assert rows_of(got.select("id", "since", "value", "t_asof", "value_asof", "other")) == sorted(want, key=str)


def test_running_totals_with_a_frequent_value(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 7, id % 50) AS v", "id")
    got = ordered.running_totals(df, ["v", "id"], {"n": F.lit(1).cast("long"), "s": F.col("id")})
    want = df.select("v", "id", F.count("id").over(Window.orderBy("v", "id")), F.sum("id").over(Window.orderBy("v", "id")))
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("size", [1, 7, 10, 103])
def test_ntile(spark, size):
    df = spark.range(size).selectExpr("id % 4 AS v", "id")
    got = ordered.ntile(df, 10, ["v", "id"], "tile").select("id", "tile")
    want = df.select("id", F.ntile(10).over(Window.orderBy("v", "id")))
    assert rows_of(got) == rows_of(want)


def test_exact_quantiles(spark):
    df = spark.range(501).selectExpr("CAST(pow(id, 2) AS DOUBLE) AS x").unionByName(spark.range(3).selectExpr("CAST(NULL AS DOUBLE) AS x"))
    got = ordered.exact_quantiles(df, "x", {"a": 0.0, "m": 0.5, "p": 0.95, "z": 1.0}).first()
    want = df.agg(*[F.percentile("x", F.lit(q)) for q in (0.0, 0.5, 0.95, 1.0)]).first()
    assert list(got) == pytest.approx(list(want))


def test_exact_quantiles_of_nothing(spark):
    assert ordered.exact_quantiles(spark.range(0).selectExpr("CAST(id AS DOUBLE) AS x"), "x", {"m": 0.5}).first().m is None


def test_top_ranked(spark):
    df = spark.range(50).selectExpr("id", "id % 7 AS v")
    got = [(r["rank"], r.id) for r in ordered.top_ranked(df, 3, [F.desc("v"), F.asc("id")]).collect()]
    assert got == [(1, 6), (2, 13), (3, 20)]
