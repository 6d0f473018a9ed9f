import datetime

import pytest
from pyspark.sql import functions as F

from innsight.operators import keys
from innsight.plans import gold


def test_dedup_latest_keeps_newest_and_null_keys(spark):
    df = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (None, 1, "a"), (None, 2, "b")], "k int, t int, v string")
    got = {(r.k, r.v) for r in keys.dedup_latest(df, ["k"], [F.desc("t")]).collect()}
    assert got == {(1, "new"), (None, "b")}


def test_dedup_latest_reduces_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    plan = keys.dedup_latest(df, ["k"], [F.desc("t")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_upsert_laws(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    source = spark.createDataFrame([(2, "B", 99), (3, "c", 30)], "k int, v string, n int")
    once = keys.upsert(target, source, ["k"], update=["v"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 10), (2, "B", 20), (3, "c", 30)]
    twice = keys.upsert(once, source, ["k"], update=["v"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    assert sorted(map(tuple, keys.upsert(target, source, ["k"]).collect())) == [(1, "a", 10), (2, "B", 99), (3, "c", 30)]


def test_upsert_can_overwrite_with_null_and_empty_source(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, None)], "k int, v string")
    assert keys.upsert(target, source, ["k"]).collect()[0].v is None
    assert keys.upsert(target, source.limit(0), ["k"]).collect()[0].v == "a"


def test_grain(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    assert tuple(keys.grain_report(df, ["a", "b"]).first()) == (3, 2, 1)
    with pytest.raises(keys.GrainError, match="3 rows, 2 keys, 1 repeated"):
        keys.validate_grain(df, ["a"])
    assert tuple(keys.grain_report(df.limit(0), ["a"]).first()) == (0, 0, 0)


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert tuple(keys.orphan_count(fact, dim, "k").first()) == (2, 1)


def test_conform_orders_casts_and_reports_nulls(spark):
    df = spark.createDataFrame([("7", datetime.date(2000, 1, 1))], "booking_id string, check_in_date date")
    shaped = keys.conform(df, gold.FACT_BOOKING_DETAIL)
    assert shaped.columns == gold.FACT_BOOKING_DETAIL.names
    assert shaped.first().booking_id == 7
    report = {r.column_name: r.null_rows for r in keys.null_report(shaped, gold.FACT_BOOKING_DETAIL).collect()}
    assert report["booking_id"] == 0 and report["status"] == 1


def test_all_references_in_one_pass(spark):
    child = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (9, None), (None, 10), (9, 99)], "a int, b int")
    other = spark.createDataFrame([(10,), (77,), (77,)], "b int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "a long")
    owner = spark.createDataFrame([(10,), (11,), (12,)], "b int")
    tables = [
        keys.Related(child, {"child_a": ("a", "a"), "child_b": ("b", "b")}), keys.Related(other, {"other_b": ("b", "b")}),
        keys.Related(parent, key=("a", "a")), keys.Related(owner, key=("b", "b")),
    ]
    assert {tuple(r) for r in keys.orphans(tables).collect()} == {("child_a", 2, 1), ("child_b", 1, 1), ("other_b", 2, 1)}
    assert {tuple(r) for r in keys.orphans(tables, nulls=True).collect()} == {("child_a", 3, 2), ("child_b", 2, 2), ("other_b", 2, 1)}
    assert {tuple(r) for r in keys.orphans([keys.Related(child.limit(0), {"none": ("a", "a")}), keys.Related(parent, key=("a", "a"))]).collect()} == {("none", 0, 0)}
    plan = keys.orphans(tables)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
