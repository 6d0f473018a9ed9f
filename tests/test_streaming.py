from pyspark.sql import Window
from pyspark.sql import functions as F

from innsight.operators import quality
from innsight.plans import rules, silver
from innsight.streaming import flows


def arrivals(catalog, name, day, folder):
    frame = catalog.source(name)
    path = f"{folder}/in"
    for year in (1996, 1999, 2100):
        low = {1996: 1900, 1999: 1996, 2100: 1999}[year]
        frame.where((F.year(day) >= low) & (F.year(day) < year)).coalesce(1).write.mode("append").parquet(path)
    return flows.stream_source(catalog.spark, path, frame.schema, "*.parquet", files_per_batch=1)


def test_stream_split_equals_batch(spark, catalog, folder):
    stream = arrivals(catalog, "bookings", "check_in", folder)
    derive = lambda df: silver.bookings(df, catalog.processed_at)
    flows.run_split(stream, derive, catalog.rules_for("bookings"), rules.BOOKING_REASONS, rules.OTHER_REASON, f"{folder}/ok", f"{folder}/bad", f"{folder}/c")
    valid, bad = spark.read.parquet(f"{folder}/ok"), spark.read.parquet(f"{folder}/bad")
    assert valid.select("batch_id").distinct().count() == 3
    columns = ["booking_id", "nights_booked", "is_long_stay"]
    batch = catalog.silver("bookings")
    assert sorted(map(tuple, valid.select(*columns).collect())) == sorted(map(tuple, batch.select(*columns).collect()))
    assert bad.count() == catalog.quarantined("bookings").count()
    assert valid.count() + bad.count() == catalog.source("bookings").count()


def test_retried_batch_leaves_no_duplicates(spark, folder):
    df = spark.range(10)
    for _ in range(2):
        flows._write_batch(df, f"{folder}/t", 0)
    assert spark.read.parquet(f"{folder}/t").count() == 10


def test_upsert_late_rows_do_not_win(spark, folder):
    newest = lambda: [F.desc("at")]
    path = f"{folder}/in"
    for rows in ([(1, 5, "a"), (2, 5, "b")], [(1, 9, "new"), (2, 1, "late")]):
        spark.createDataFrame(rows, "k int, at int, v string").coalesce(1).write.mode("append").parquet(path)
        stream = flows.stream_source(spark, path, spark.read.parquet(path).schema)
        flows.run_upsert(stream, lambda d: d, ["k"], newest, f"{folder}/out", f"{folder}/c")
    want = {(1, "new"), (2, "b")}
    assert {(r.k, r.v) for r in flows.current_rows(spark, f"{folder}/out", ["k"], newest()).collect()} == want
    assert {(r.k, r.v) for r in flows.compact(spark, f"{folder}/out", ["k"], newest()).collect()} == want
    assert spark.read.parquet(f"{folder}/out/base").count() == 2


def test_batches_are_reduced_before_columns_are_derived(spark, folder):
    rows = [(k, at, f"{k}-{at}") for k in range(5) for at in range(4)]
    spark.createDataFrame(rows, "k int, at int, v string").coalesce(1).write.parquet(f"{folder}/in")
    stream = flows.stream_source(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema)
    derive = lambda df: df.withColumn("seen", F.count(F.lit(1)).over(Window.partitionBy("k")))
    flows.run_upsert(stream, derive, ["k"], lambda: [F.desc("at")], f"{folder}/out", f"{folder}/c", reduce_first=True)
    got = flows.compact(spark, f"{folder}/out", ["k"], [F.desc("at")]).collect()
    assert {(r.k, r.v, r.seen) for r in got} == {(k, f"{k}-3", 1) for k in range(5)}


def test_retry_of_a_compacted_batch_loses_nothing(spark, folder):
    newest = lambda: [F.desc("at")]
    for batch in range(3):
        flows._write_batch(spark.range(batch * 50, batch * 50 + 50).selectExpr("id AS k", "1 AS at"), f"{folder}/out/changes", batch)
    assert flows.compact(spark, f"{folder}/out", ["k"], newest()).count() == 150
    flows._write_batch(spark.range(100, 150).selectExpr("id AS k", "1 AS at"), f"{folder}/out/changes", 2)
    assert flows.current_rows(spark, f"{folder}/out", ["k"], newest()).count() == 150
    flows._write_batch(spark.range(0, 10).selectExpr("id AS k", "2 AS at"), f"{folder}/out/changes", 3)
    assert flows.compact(spark, f"{folder}/out", ["k"], newest()).where("at = 2").count() == 10
    assert flows.compact(spark, f"{folder}/out", ["k"], newest()).count() == 150


def test_counters_of_many_batches_all_arrive(spark, folder):
    spark.range(30).repartition(30).write.parquet(f"{folder}/in")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        stream = flows.stream_source(spark, f"{folder}/in", spark.range(1).schema, "*.parquet", files_per_batch=2)
        seen = flows.run_with_metrics(stream, lambda d: d, [], f"{folder}/o", f"{folder}/c", "many")
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert len(seen) > 5 and sum(b["rows_seen"] for b in seen) == 30


def test_stream_metrics_add_up(spark, catalog, folder):
    stream = arrivals(catalog, "bookings", "check_in", folder)
    seen = flows.run_with_metrics(stream, lambda d: silver.bookings(d, catalog.processed_at), catalog.rules_for("bookings"), f"{folder}/o", f"{folder}/c", "warned")
    report = {r.rule_name: r.violations for r in quality.violation_report(catalog.silver("bookings"), quality.warnings(catalog.rules_for("bookings"))).collect()}
    for rule, count in report.items():
        assert sum(b[rule] for b in seen) == count
    assert sum(b["rows_seen"] for b in seen) == catalog.silver("bookings").count()


def test_violation_log_listens_to_batches(spark, catalog, folder):
    import time

    log = flows.ViolationLog("listened")
    spark.streams.addListener(log)
    try:
        stream = arrivals(catalog, "bookings", "check_in", folder)
        seen = flows.run_with_metrics(stream, lambda d: silver.bookings(d, catalog.processed_at), catalog.rules_for("bookings"), f"{folder}/o", f"{folder}/c", "listened")
        for _ in range(50):
            if len(log.batches) >= len(seen):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    assert sorted(b["batch_id"] for b in log.batches) == sorted(b["batch_id"] for b in seen)
    assert sum(b["rows_seen"] for b in log.batches) == sum(b["rows_seen"] for b in seen)
