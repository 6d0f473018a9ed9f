from pyspark.sql import functions as F

from innsight.operators.keys import orphan_count
from innsight.plans import gold
from innsight.sources import storage
from innsight.sources.synthetic import synthetic_bookings


def test_ingest_counts_and_overwrites(spark, folder):
    spark.range(7).write.parquet(f"{folder}/src")
    for _ in range(2):
        assert storage.ingest_table(spark, f"{folder}/src", f"{folder}/dst", "numbers") == 7
    landed = spark.read.parquet(f"{folder}/dst")
    assert landed.count() == 7 and set(landed.columns) == {"id", "_bronze_ingestion_timestamp", "_bronze_source_table"}


def test_swap_replaces_and_creates(spark, folder):
    spark.range(3).write.parquet(f"{folder}/new")
    storage.swap_in(spark, f"{folder}/new", f"{folder}/deep/table")
    spark.range(5).write.parquet(f"{folder}/new")
    storage.swap_in(spark, f"{folder}/new", f"{folder}/deep/table")
    assert spark.read.parquet(f"{folder}/deep/table").count() == 5


def test_shared_dir_is_the_configured_one(spark):
    assert storage.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_synthetic_facts_keep_foreign_keys_and_repeat(catalog):
    like, listings, people = catalog.table("fact_booking_detail"), catalog.table("dim_property"), catalog.table("dim_user")
    first, again = (synthetic_bookings(like, listings, people, seed=7) for _ in range(2))
    assert orphan_count(first, listings, "property_id").first().orphan_rows == 0
    assert first.exceptAll(again).count() == 0
    assert synthetic_bookings(like, listings, people, seed=8).join(first.select("booking_id", F.col("user_id").alias("u")), "booking_id").where("u <> user_id").count() > 0


def test_paid_bookings_hold_only_what_the_facts_read(catalog):
    assert set(catalog.plan("paid_bookings").columns) == {*gold.BOOKED_COLUMNS, "payment_amount", "payment_method"}


def test_stored_tables_are_written_without_a_further_shuffle(spark, catalog, monkeypatch):
    frame, hints = type(spark.range(1)), []
    own = frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, name, *more: hints.append(name) or own(df, name, *more))
    fresh = type(catalog)(spark, catalog.root)
    assert fresh.table("fact_booking_detail").count() == catalog.plan("fact_booking_detail").count() and not hints
    assert fresh.store("more", lambda: spark.range(3).toDF("id")).count() == 3 and hints == ["rebalance"]
