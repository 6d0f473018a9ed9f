"""The summary of a profile is that of the long table, without making it."""

from pyspark.sql import functions as F

from innsight.plans import monitor
from innsight.plans.monitor import Monitor

SALES = Monitor("sales", "sales", {"total": "SUM(v)", "n": "COUNT(v)"}, {"each": "try_divide(total, n)"}, {}, ("shop", "place"), "day")


def _rows(spark):
    return spark.createDataFrame(
        [(1, None, "2001-01-01", 5.0), (1, None, "2001-01-02", 7.0), (2, None, "2001-01-09", None), (None, None, "2001-01-09", 1.0), (3, None, None, 2.0)],
        "shop int, place string, day string, v double").withColumn("day", F.col("day").cast("date"))


def test_summary_equals_the_long_profile(spark):
    rows = _rows(spark)
    long = monitor.profile(rows, SALES).groupBy("granularity", "slice_key", "metric").agg(
        F.count(F.lit(1)).alias("windows"), F.countDistinct("slice_value").alias("slices"), F.max("value").alias("largest"))
    want = {tuple(r) for r in long.collect()}
    assert {tuple(r) for r in monitor.profile_summary(rows, SALES).collect()} == want
    assert len(want) == 18
    assert monitor.profile_summary(rows.limit(0), SALES).collect() == []


def test_registered_summary_hands_on_few_rows(spark, catalog):
    """Windows are grouped by granularity and slice alone; no group per slice value and metric."""
    from registry import watch

    plan = watch.QUERIES["monitor_profile"](catalog)._jdf.queryExecution().optimizedPlan().toString()
    groups = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert not any("metric" in line.split("]")[0] for line in groups)
