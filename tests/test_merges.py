import pytest
from pyspark.sql import functions as F

from innsight.operators.keys import GrainError
from innsight.plans.merges import merge_table


def facts(spark, rows):
    return spark.createDataFrame(rows, "booking_id long, status string, guests_count int, updated_at string, payment_amount double, payment_method string, is_cancelled boolean").withColumn(
        "check_in_date", F.lit("2000-01-01").cast("date")
    )


def test_merge_inserts_updates_and_repeats(spark, folder):
    path = f"{folder}/fact"
    merge_table(facts(spark, [(1, "confirmed", 2, "a", None, None, False), (2, "confirmed", 3, "a", None, None, False)]), path, "fact_booking_detail")
    change = facts(spark, [(2, "cancelled", 99, "b", 5.0, "paypal", True), (3, "confirmed", 1, "b", None, None, False)])
    for _ in range(2):
        got = merge_table(change, path, "fact_booking_detail")
    assert sorted((r.booking_id, r.status, r.guests_count, r.payment_amount) for r in got.collect()) == [
        (1, "confirmed", 2, None), (2, "cancelled", 3, 5.0), (3, "confirmed", 1, None)
    ]


def test_broken_grain_leaves_the_target_alone(spark, folder):
    path = f"{folder}/fact"
    merge_table(facts(spark, [(1, "confirmed", 2, "a", None, None, False)]), path, "fact_booking_detail")
    with pytest.raises(GrainError):
        merge_table(facts(spark, [(2, "x", 1, "a", None, None, False)] * 2), path, "fact_booking_detail")
    assert spark.read.parquet(path).count() == 1


def test_only_touched_months_are_rewritten(spark, folder):
    import glob
    import os

    path = f"{folder}/fact"
    rows = facts(spark, [(k, "confirmed", 2, "a", None, None, False) for k in range(6)]).withColumn("check_in_date", F.expr("add_months(DATE'2000-01-15', cast(booking_id % 3 as int))"))
    merge_table(rows, path, "fact_booking_detail")
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/part_month=*/*.parquet")}
    # The changed row now names another month; its stored month is the one to rewrite, and the named one is looked at.
    change = facts(spark, [(1, "cancelled", 9, "b", None, None, True)]).withColumn("check_in_date", F.lit("2000-01-20").cast("date"))
    got = merge_table(change, path, "fact_booking_detail")
    assert sorted((r.booking_id, r.status) for r in got.collect()) == [(k, "cancelled" if k == 1 else "confirmed") for k in range(6)]
    after = set(glob.glob(f"{path}/part_month=*/*.parquet"))
    assert {p.split("part_month=")[1][:7] for p in before if p in after} == {"2000-03"}


def test_versions_merge_once_and_check_their_grain(spark, folder):
    from innsight.operators.history import initial_versions
    from innsight.plans.merges import merge_versions

    base = spark.createDataFrame([(1, "rome", "a", False), (2, None, "b", True)], "user_id int, country string, user_type string, is_business boolean")
    path = f"{folder}/dim_user"
    merge_versions(initial_versions(base, "user_id", F.lit("2000-01-01").cast("date"), "user_key"), path, "dim_user", "since")
    batch = base.withColumn("country", F.lit("oslo")).withColumn("since", F.lit("2000-05-01").cast("date"))
    for _ in range(2):
        got = merge_versions(batch, path, "dim_user", "since")
    assert got.count() == 4 and got.where("is_current").count() == 2
    with pytest.raises(GrainError):
        merge_versions(batch.union(batch), path, "dim_user", "since")
    assert spark.read.parquet(path).count() == 4


def test_a_batch_reads_the_keys_of_the_months_that_hold_them(spark, folder):
    import shutil

    from innsight.plans import merges
    from innsight.sources.storage import parts, read_parts

    path, months = f"{folder}/fact", 100
    day = F.expr("add_months(DATE'1990-01-15', cast(floor(booking_id / 40) as int))")
    rows = facts(spark, []).unionByName(spark.range(40 * months).selectExpr(
        "id AS booking_id", "'confirmed' AS status", "2 AS guests_count", "'a' AS updated_at", "CAST(NULL AS DOUBLE) AS payment_amount", "CAST(NULL AS STRING) AS payment_method", "FALSE AS is_cancelled",
        "DATE'1990-01-15' AS check_in_date")).withColumn("check_in_date", day)
    merge_table(rows, path, "fact_booking_detail")
    assert len(parts(spark, path, "part_month")) == months
    # Keys of two months, named under a third one, and a new key under a fourth.
    change = rows.where("booking_id IN (5, 401)").withColumns({"status": F.lit("cancelled"), "check_in_date": F.lit("1995-01-01").cast("date")})
    change = change.unionByName(change.where("booking_id = 5").withColumns({"booking_id": F.lit(10**9), "check_in_date": F.lit("1996-01-01").cast("date")}))
    schema = spark.read.parquet(path).schema
    found, read = merges.months_to_rewrite(change, path, ["booking_id"], "check_in_date", schema)
    assert found == ["1990-01", "1990-11", "1995-01", "1996-01"]
    assert set(read) >= {"1990-01", "1990-11"} and len(read) <= 6
    files = read_parts(spark, path, "part_month", read, schema).inputFiles()
    assert {f.split("part_month=")[1][:7] for f in files} == set(read)
    got = merge_table(change, path, "fact_booking_detail")
    assert got.where("status = 'cancelled'").count() == 3 and got.count() == 40 * months + 1
    # A key that came with the last batch is found through the index, whatever month the next batch names.
    again = change.where("booking_id = 1000000000").withColumn("check_in_date", F.lit("1991-01-01").cast("date"))
    assert "1996-01" in merges.months_to_rewrite(again, path, ["booking_id"], "check_in_date", schema)[0]
    assert merge_table(again, path, "fact_booking_detail").count() == 40 * months + 1
    # A month whose index is missing is looked into.
    shutil.rmtree(f"{path}/_keys/index/part_month=1990-11")
    found, read = merges.months_to_rewrite(change.where("booking_id = 401"), path, ["booking_id"], "check_in_date", schema)
    assert "1990-11" in found and "1990-11" in read


def test_key_index_never_misses_and_ranges_exclude(spark):
    from innsight.operators.keyindex import build_key_index, parts_that_may_hold

    rows = spark.range(5000).selectExpr("id AS a", "concat('k', id % 7) AS b", "cast(id % 11 as string) AS part").union(spark.createDataFrame([(None, "x", "nulls")], "a long, b string, part string"))
    index = build_key_index(rows, "part", ["a", "b"])
    index.cache()
    for batch, least, most in ((rows.where("a = 12"), {"1"}, 3), (rows.where("a IN (12, 24, 46)"), {"1", "2"}, 4), (rows.where("a > 100"), set(map(str, range(11))), 11), (rows.where("a IS NULL"), set(), 0)):
        got = {r[0] for r in parts_that_may_hold(index, batch, "part", ["a", "b"]).collect()}
        assert got >= least and len(got) <= most
    unknown = spark.range(10_000, 12_000).selectExpr("id AS a", "'k' AS b")
    assert parts_that_may_hold(index, unknown, "part", ["a", "b"]).count() == 0  # beyond every range
    false = spark.range(0, 2_000).selectExpr("id AS a", "'other' AS b")
    assert len(parts_that_may_hold(index, false.where("a < 20"), "part", ["a", "b"]).collect()) <= 4
    index.unpersist()


def test_a_date_in_the_key_needs_no_search(spark, folder):
    from innsight.plans import merges

    rows = spark.range(60).selectExpr("id AS property_id", "add_months(DATE'2000-01-01', cast(id % 12 as int)) AS engagement_date", *[
        f"1L AS {c}" for c in ("view_count", "unique_user_views", "click_count", "search_count", "conversion_rate", "avg_time_on_page")])
    path = f"{folder}/engagement"
    merge_table(rows, path, "fact_property_engagement")
    change = rows.where("engagement_date = DATE'2000-03-01'").withColumn("view_count", F.lit(7).cast("long"))
    assert merges.months_to_rewrite(change, path, ["property_id", "engagement_date"], "engagement_date", spark.read.parquet(path).schema) == (["2000-03"], [])
    assert merge_table(change, path, "fact_property_engagement").where("view_count = 7").count() == 5


def _versions(spark, folder, keys=400):
    from innsight.operators.history import initial_versions

    base = spark.range(keys).selectExpr("id AS user_id", "'rome' AS country", "'a' AS user_type", "FALSE AS is_business")
    return base, initial_versions(base, "user_id", F.lit("2000-01-01").cast("date"), "user_key"), f"{folder}/dim_user"


def test_history_is_never_written_again(spark, folder):
    import glob
    import os

    from innsight.plans.merges import merge_versions

    base, first, path = _versions(spark, folder)
    merge_versions(first, path, "dim_user", "since")
    change = lambda ids, city, day: base.where(F.col("user_id").isin(ids)).withColumns({"country": F.lit(city), "since": F.lit(day).cast("date")})
    merge_versions(change(list(range(400)), "oslo", "2000-02-01"), path, "dim_user", "since")
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/*/*/*.parquet")}
    got = merge_versions(change([3, 9], "bern", "2000-03-01"), path, "dim_user", "since")
    after = set(glob.glob(f"{path}/*/*/*.parquet"))
    gone, new = set(before) - after, after - set(before)
    assert all("state=current" in p for p in gone) and 1 <= len({p.split("part=")[1] for p in gone}) and len(gone) <= 4
    assert sum(os.stat(p).st_size for p in new) < sum(os.stat(p).st_size for p in after) / 4
    assert got.count() == 802 and sorted(r.user_id for r in got.where("country = 'bern' AND is_current").collect()) == [3, 9]
    assert got.where("country = 'oslo' AND NOT is_current").count() == 2


def test_a_repeat_after_half_a_commit_changes_nothing_more(spark, folder, monkeypatch):
    import glob
    import shutil

    from innsight.plans.merges import merge_versions, read_versions

    base, first, path = _versions(spark, folder, 60)
    merge_versions(first, path, "dim_user", "since")
    copy = f"{folder}/copy"
    shutil.copytree(path, copy)
    batch = base.withColumns({"country": F.lit("oslo"), "since": F.lit("2000-02-01").cast("date")})
    want = sorted(map(str, merge_versions(batch, path, "dim_user", "since").collect()))
    # The copy has the closed versions of the batch, and half of its buckets, as after a failure between the writes.
    for folder_name in sorted(glob.glob(f"{path}/state=closed/*")):
        shutil.copytree(folder_name, folder_name.replace(path, copy))
    for folder_name in sorted(glob.glob(f"{path}/state=current/*"))[::2]:
        shutil.rmtree(folder_name.replace(path, copy))
        shutil.copytree(folder_name, folder_name.replace(path, copy))
    assert sorted(map(str, merge_versions(batch, copy, "dim_user", "since").collect())) == want
    assert sorted(map(str, read_versions(spark, copy).collect())) == want


def test_first_load_after_a_failed_one(spark, folder):
    import os

    os.makedirs(f"{folder}/fact/_keys/index")  # the index was written, the rows were not
    assert merge_table(facts(spark, [(1, "confirmed", 2, "a", None, None, False)]), f"{folder}/fact", "fact_booking_detail").count() == 1


def test_first_load_takes_closed_versions(spark, folder):
    from innsight.plans.merges import merge_versions

    rows = spark.createDataFrame(
        [("a", 1, "rome", "x", False, "2000-01-01", "2000-02-01", False), ("b", 1, "oslo", "x", False, "2000-02-01", None, True)],
        "user_key string, user_id long, country string, user_type string, is_business boolean, effective_from string, effective_to string, is_current boolean",
    ).withColumns({c: F.col(c).cast("date") for c in ("effective_from", "effective_to")})
    assert merge_versions(rows, f"{folder}/dim", "dim_user", "since").count() == 2
    with pytest.raises(GrainError):
        merge_versions(rows.union(rows), f"{folder}/other", "dim_user", "since")
