"""Keyed merges of the modelled tables into stored ones."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.operators.history import scd2_apply
from innsight.operators.keyindex import build_key_index, parts_that_may_hold
from innsight.operators.keys import upsert, validate_grain
from innsight.sources.storage import materialize, parts, read_parts, swap_in, write_table

MONTH = "part_month"


@dataclass(frozen=True)
class Target:
    """Key of a stored table and the columns a match overwrites (None: all); a table with a date is stored by month.

    A match never overwrites that date, so a row stays in its month.
    """

    keys: tuple[str, ...]
    update: tuple[str, ...] | None = None
    cluster_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Versioned:
    """Key, version key and compared attributes of a stored type 2 dimension."""

    key: str
    key_name: str
    tracked: tuple[str, ...]


# Merge keys and updated columns per table.
TARGETS = {
    "dim_destination": Target(("destination_id",)),
    "dim_weather_location": Target(("locationKey",)),
    "fact_booking_detail": Target(
        ("booking_id",), ("status", "updated_at", "payment_amount", "payment_method", "is_cancelled"), ("check_in_date",)
    ),
    "fact_booking_daily": Target(
        ("property_id", "check_in_date"),
        (
            "booking_count", "total_booking_value", "avg_booking_value", "total_guests", "avg_nights_booked", "cancellation_count",
            "confirmed_booking_count", "payment_completion_rate",
        ),
        ("check_in_date",),
    ),
    "fact_property_engagement": Target(
        ("property_id", "engagement_date"),
        ("view_count", "unique_user_views", "click_count", "search_count", "conversion_rate", "avg_time_on_page"),
        ("engagement_date",),
    ),
    "fact_weather_daily": Target(
        ("locationKey", "date"),
        (
            "temperatureMin", "temperatureMax", "realFeelMin", "realFeelMax", "hoursOfSun", "precipitationProbability", "thunderstormProbability",
            "rainProbability", "snowProbability", "iceProbability", "temperature_range", "is_precipitation_expected",
        ),
        ("date",),
    ),
}


VERSIONED = {
    "dim_user": Versioned("user_id", "user_key", ("country", "user_type", "is_business")),
    "dim_host": Versioned("host_id", "host_key", ("is_verified", "is_active", "rating")),
    "dim_property": Versioned("property_id", "property_key", ("base_price", "property_type", "host_id")),
}


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        # A first load that failed leaves a folder without rows.
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _by_month(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(MONTH, F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("none")))


def _index_path(path: str) -> str:
    return f"{path}/_keys/index"  # folders that begin so are not read with the table


def months_to_rewrite(batch: DataFrame, path: str, keys: list[str], day: str, schema: T.StructType) -> tuple[list[str], list[str]]:
    """(months a batch changes, months whose keys were read to find them) of a table stored by month.

    A batch changes the months it names and those that hold one of its keys. If the date is
    part of the key, no other month can hold it. Else the key index leaves a few months, and
    only their key columns are read; a month without an index is always among them.
    """
    spark = batch.sparkSession
    named = {r[0] for r in _by_month(batch, day).select(MONTH).distinct().collect()}  # as many as the calendar has
    if day in keys:
        return sorted(named), []
    there = parts(spark, path, MONTH)
    index = _stored(spark, _index_path(path))
    if index is not None:
        possible = {r[0] for r in parts_that_may_hold(index.withColumn(MONTH, F.col(MONTH).cast("string")), batch, MONTH, keys).collect()}
        indexed = set(parts(spark, _index_path(path), MONTH))
        there = [m for m in there if m in possible or m not in indexed]
    held = read_parts(spark, path, MONTH, there, schema).select(*keys, MONTH).join(batch.select(*keys), keys, "left_semi").select(MONTH).distinct()
    return sorted(named | {r[0] for r in held.collect()}), there


def merge_table(source: DataFrame, path: str, name: str) -> DataFrame:
    """Merge ``source`` into the table at ``path`` and return the stored result.

    The source is written once; its grain is checked on the written rows, so a broken
    grain raises before the target is touched. Merging the same rows again changes nothing.

    A table with a date is stored by month. Only months that hold a row of the source, or
    a stored row that one of its keys matches, are read, merged and replaced. A key index of
    the months beside the table finds them, so of all others not even the keys are read; it
    is written before the rows, and names a month too many rather than one too few if the
    write of the rows fails. A table without a date is staged beside the target and swapped in.
    """
    spark, target = source.sparkSession, TARGETS[name]
    path = path.rstrip("/")
    incoming = validate_grain(materialize(source, f"merge-{name}"), target.keys)
    stored = _stored(spark, path)
    if not target.cluster_by:
        if stored is None:
            return write_table(incoming, path)
        staged = f"{path}-staged-{uuid.uuid4().hex[:12]}"
        write_table(upsert(stored, incoming, target.keys, target.update), staged)
        swap_in(spark, staged, path)
        return spark.read.schema(stored.schema).parquet(path)

    day, keys = target.cluster_by[0], list(target.keys)
    columns = incoming.columns if stored is None else [c for c in stored.columns if c != MONTH]
    schema = (incoming if stored is None else stored).select(*columns).schema.add(MONTH, T.StringType())
    merged, dated = _by_month(incoming, day), _by_month(incoming, day).select(*keys, MONTH)
    if stored is not None:
        months, _ = months_to_rewrite(incoming, path, keys, day, schema)
        there = set(parts(spark, path, MONTH))
        old = read_parts(spark, path, MONTH, [m for m in months if m in there], schema)
        dated = old.select(*keys, MONTH).union(dated)
        merged = _by_month(upsert(old.select(*columns), incoming, keys, target.update), day)
    dynamic = {"partitionOverwriteMode": "dynamic"}
    if day not in keys:
        build_key_index(dated, MONTH, keys).write.mode("overwrite").options(**dynamic).partitionBy(MONTH).parquet(_index_path(path))
    # Files are replaced when the job commits, after all of them were read.
    out = merged.select(*columns, MONTH).hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, *target.cluster_by)
    out.write.mode("overwrite").options(**dynamic).partitionBy(MONTH).parquet(path)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path).select(*columns)


BUCKETS = 16


def _bucket(key: str, buckets: int):
    return F.format_string(f"%03d-{buckets:03d}", F.pmod(F.xxhash64(key), F.lit(buckets)))


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """A stored type 2 dimension, closed and current versions."""
    return spark.read.parquet(path).drop("state", "part")


def merge_versions(source: DataFrame, path: str, name: str, since: str, buckets: int = BUCKETS) -> DataFrame:
    """Merge a change batch into the stored type 2 dimension at ``path`` and return the stored result.

    ``source`` holds one row per key with the dimension's attributes and its change time
    ``since``; the grain is checked before the target is touched. The first batch must be the
    dimension itself, versions included: one row per key and start. Applying a batch twice
    changes nothing.

    Current versions lie in ``buckets`` by hash of the key, closed ones in folders that only
    grow. A batch reads and rewrites the buckets of its keys and adds the versions it closes,
    so history is never read nor written again. Closed versions are written first, in a
    folder of their bucket and of the batch: a repeat after a failure finds a bucket either
    done, and leaves its folder alone, or not, and writes the same folder again.
    """
    spark, target = source.sparkSession, VERSIONED[name]
    path = path.rstrip("/")
    stored = _stored(spark, path)
    incoming = materialize(source, f"merge-{name}")
    validate_grain(incoming, [target.key] if stored is not None else [target.key, "effective_from"])
    write = lambda df: df.sortWithinPartitions("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("state", "part").parquet(path)
    if stored is None:
        first = incoming.withColumn("state", F.when(F.col("is_current"), "current").otherwise("closed"))
        part = F.when(F.col("is_current"), _bucket(target.key, buckets)).otherwise(F.concat(_bucket(target.key, buckets), F.lit("-first")))
        write(first.withColumn("part", part).hint("rebalance", F.col("state"), F.col("part")))
        return read_versions(spark, path)
    columns = [c for c in stored.columns if c not in ("state", "part")]
    schema = stored.select(*columns).schema.add("part", T.StringType())
    there = parts(spark, f"{path}/state=current", "part")
    buckets = int(there[0].split("-")[1]) if there else buckets
    touched = sorted(r[0] for r in incoming.select(_bucket(target.key, buckets)).distinct().collect())
    current = read_parts(spark, f"{path}/state=current", "part", [b for b in touched if b in set(there)], schema).select(*columns)
    applied = scd2_apply(current, incoming, target.key, target.tracked, target.key_name, since)
    applied = materialize(applied.withColumn("part", _bucket(target.key, buckets)), f"applied-{name}")
    batch = _digest(incoming)
    write(applied.where(~F.col("is_current")).withColumns({"state": F.lit("closed"), "part": F.concat("part", F.lit(f"-{batch}"))}))
    write(applied.where("is_current").withColumn("state", F.lit("current")).hint("rebalance", F.col("part")))
    spark.catalog.refreshByPath(path)
    return read_versions(spark, path)


def _digest(batch: DataFrame) -> str:
    """A name that equal batches share."""
    row = batch.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*batch.columns)).alias("x"), F.sum(F.xxhash64(*batch.columns).cast("decimal(38,0)")).alias("s")).first()
    return hashlib.md5(f"{row.n}|{row.x}|{row.s}".encode()).hexdigest()[:16]
