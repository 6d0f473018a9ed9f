import datetime as dt

from pyspark.sql import functions as F

from innsight.operators import history

TRACKED = ["city"]


def base(spark):
    df = spark.createDataFrame([(1, "rome", "Ann"), (2, "oslo", "Bo"), (3, None, "Cy")], "k int, city string, name string")
    return history.initial_versions(df, "k", F.lit("2000-01-01").cast("date"), "k_key")


def batch(spark, rows, since="2000-02-01"):
    return spark.createDataFrame(rows, "k int, city string, name string").withColumn("since", F.lit(since).cast("date"))


def test_scd2_closes_and_opens_only_changed_keys(spark):
    out = history.scd2_apply(base(spark), batch(spark, [(1, "paris", "Ann"), (2, "oslo", "Renamed"), (3, "lima", "Cy"), (4, "bern", "Di")]), "k", TRACKED, "k_key", "since")
    rows = {(r.k, r.city, r.is_current, str(r.effective_from), str(r.effective_to)) for r in out.collect()}
    assert rows == {
        (1, "rome", False, "2000-01-01", "2000-02-01"), (1, "paris", True, "2000-02-01", "None"), (2, "oslo", True, "2000-01-01", "None"),
        (3, None, False, "2000-01-01", "2000-02-01"), (3, "lima", True, "2000-02-01", "None"), (4, "bern", True, "2000-02-01", "None"),
    }
    assert history.version_problems(out, "k").count() == 0
    assert out.where("is_current").groupBy("k").count().where("count > 1").count() == 0


def test_scd2_is_idempotent_and_ignores_late_changes(spark):
    once = history.scd2_apply(base(spark), batch(spark, [(1, "paris", "Ann")]), "k", TRACKED, "k_key", "since")
    twice = history.scd2_apply(once, batch(spark, [(1, "paris", "Ann")]), "k", TRACKED, "k_key", "since")
    late = history.scd2_apply(once, batch(spark, [(1, "kyiv", "Ann")], "1999-01-01"), "k", TRACKED, "k_key", "since")
    want = sorted(map(str, once.collect()))
    assert sorted(map(str, twice.collect())) == want
    assert sorted(map(str, late.collect())) == want


def test_history_collapses_repeats_and_takes_late_rows(spark):
    log = spark.createDataFrame(
        [(1, "2000-03-05", 3, "b"), (1, "2000-01-01", 1, "a"), (1, "2000-01-20", 2, "a"), (1, "2000-02-01", 9, "late"), (1, "2000-03-05", 4, "c"), (2, "2000-01-01", 1, None)],
        "k int, day string, id int, v string",
    ).withColumn("day", F.col("day").cast("date"))
    out = history.scd2_history(log, "k", "day", ["v"], [F.desc("id")])
    d = dt.date
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [
            (1, "a", d(2000, 1, 1), d(2000, 2, 1), False), (1, "late", d(2000, 2, 1), d(2000, 3, 5), False), (1, "c", d(2000, 3, 5), None, True),
            (2, None, d(2000, 1, 1), None, True),
        ],
        key=str,
    )
    assert history.version_problems(out, "k").count() == 0


def test_version_problems_finds_both_kinds(spark):
    bad = spark.createDataFrame(
        [(1, "2000-01-01", "2000-03-01", False), (1, "2000-02-01", None, True), (2, "2000-01-01", None, True), (2, "2000-05-01", None, True)],
        "k int, effective_from string, effective_to string, is_current boolean",
    ).selectExpr("k", "DATE(effective_from) AS effective_from", "DATE(effective_to) AS effective_to", "is_current")
    got = {(r.k, r.problem) for r in history.version_problems(bad, "k").collect()}
    assert got == {(1, "overlap"), (2, "overlap"), (2, "several_current")}


def test_late_changes_in_any_order_give_the_rebuilt_history(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.randrange(12), dt.date(2000, 1, 1) + dt.timedelta(rng.randrange(40)), n, rng.choice(["a", "b", None])) for n in range(400)]
    log = spark.createDataFrame(rows, "k int, day date, id int, v string")
    args = ("k", "day", ["v"], "id")
    text = lambda df: sorted(map(str, df.collect()))
    want = history.scd2_from_log(log, *args)
    plain = history.scd2_history(log, "k", "day", ["v"], [F.desc("id")])
    assert text(want.drop("decided", "repeats")) == text(plain)
    for seed in range(3):
        order = random.Random(seed).sample(range(5), 5)
        out = history.scd2_from_log(log.limit(0), *args)
        for part in (*order, order[0]):  # the first batch comes once more at the end
            out = spark.createDataFrame(history.scd2_insert(out, log.where(F.col("id") % 5 == part), *args).collect(), want.schema)
        assert text(out) == text(want)


def test_untouched_keys_and_odd_rows(spark):
    log = spark.createDataFrame([(1, "2000-01-01", 1, "a"), (1, "2000-03-01", 2, "a"), (2, "2000-01-01", 3, "x")], "k int, day string, id int, v string")
    args = ("k", "day", ["v"], "id")
    first = history.scd2_from_log(log, *args)
    late = spark.createDataFrame([(1, "2000-02-01", 9, "b"), (None, "2000-02-01", 9, "b"), (2, None, 9, "b")], log.schema)
    got = sorted((r.k, r.v, r.effective_from, r.effective_to) for r in history.scd2_insert(first, late, *args).collect())
    assert got == [(1, "a", "2000-01-01", "2000-02-01"), (1, "a", "2000-03-01", None), (1, "b", "2000-02-01", "2000-03-01"), (2, "x", "2000-01-01", None)]


def test_late_changes_are_written_without_a_further_shuffle(catalog, monkeypatch):
    from registry import modelling

    plans = []

    def seen(df, label, cluster_by=(), rebalance=True):
        plans.append(rebalance)
        return materialize(df, label, cluster_by, rebalance)

    from innsight.sources.storage import materialize

    monkeypatch.setattr(modelling, "materialize", seen)
    modelling.QUERIES["scd2_late_changes"](catalog)
    assert plans == [False] * 4
