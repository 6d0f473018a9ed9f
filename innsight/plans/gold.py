"""Dimensions and daily facts.

Builders take cleaned frames and return the table; writing and merging is up to the
caller. Each is one declarative plan: keys are reduced before they are joined, and
skewed booking-level joins are left to adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.operators.history import initial_versions
from innsight.operators.keys import dedup_latest, surrogate_key

MONEY = "decimal(18,2)"


def _field(name: str, kind: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, kind, not required)


_LONG, _INT, _STR, _BOOL, _DATE = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.DateType()
_CASH = T.DecimalType(18, 2)

# Declared schemas of the facts the pipeline conforms to.
FACT_BOOKING_DETAIL = T.StructType(
    [
        _field("booking_id", _LONG, True),
        _field("user_id", _LONG, True),
        _field("host_id", _LONG),
        _field("property_id", _LONG, True),
        _field("destination_id", _LONG),
        _field("check_in_date", _DATE, True),
        _field("check_out_date", _DATE, True),
        _field("guests_count", _INT, True),
        _field("nights_booked", _INT, True),
        _field("total_amount", _CASH, True),
        _field("payment_amount", _CASH),
        _field("payment_method", _STR),
        _field("status", _STR, True),
        _field("created_at", _DATE, True),
        _field("updated_at", _DATE),
        _field("days_between_booking_and_checkin", _INT),
        _field("is_cancelled", _BOOL, True),
        _field("is_business_booking", _BOOL, True),
    ]
)
FACT_BOOKING_DAILY = T.StructType(
    [
        _field("property_id", _LONG, True),
        _field("destination_id", _LONG),
        _field("check_in_date", _DATE, True),
        _field("booking_count", _LONG, True),
        _field("confirmed_booking_count", _LONG, True),
        _field("cancellation_count", _LONG, True),
        _field("total_booking_value", _CASH, True),
        _field("avg_booking_value", _CASH),
        _field("total_guests", _LONG, True),
        _field("avg_nights_booked", T.DecimalType(10, 2)),
        _field("payment_completion_rate", T.DecimalType(5, 2)),
    ]
)


def dim_user(silver: DataFrame, loaded_at: Column) -> DataFrame:
    newest = dedup_latest(silver, ["user_id"], [F.desc("processed_timestamp"), F.asc("user_business_key")])
    kept = newest.select(
        "user_id", "email", "name", "country", "user_type", "is_business", "company_name",
        F.col("created_at").cast("date").alias("created_at"),
    )
    return initial_versions(kept, "user_id", loaded_at, "user_key")


def dim_host(silver: DataFrame, loaded_at: Column) -> DataFrame:
    newest = dedup_latest(silver, ["host_id"], [F.desc("processed_timestamp"), F.asc("host_business_key")])
    kept = newest.select(
        "host_id", "name", "email", "phone", "is_verified", "is_active", "rating", "country", "joined_at"
    )
    return initial_versions(kept, "host_id", loaded_at, "host_key")


def dim_property(silver: DataFrame, loaded_at: Column) -> DataFrame:
    newest = dedup_latest(silver, ["property_id"], [F.desc("processed_timestamp"), F.asc("property_business_key")])
    kept = newest.select(
        "property_id", "host_id", "destination_id", "title", "description", "base_price", "property_type",
        "max_guests", "bedrooms", "bathrooms", "property_latitude", "property_longitude", "created_at",
    )
    return initial_versions(kept, "property_id", loaded_at, "property_key")


def dim_destination(silver: DataFrame) -> DataFrame:
    newest = dedup_latest(
        silver, ["destination_id"], [F.desc("processed_timestamp"), F.asc("destination_business_key")]
    )
    return newest.select(
        surrogate_key("destination_id").alias("destination_key"),
        "destination_id", "destination", "country", "state_or_province", "state_or_province_code", "description",
    )


def dim_date(spark, first: str = "2020-01-01", last: str = "2030-12-31") -> DataFrame:
    """Calendar between two dates; ``day_of_week`` starts on Sunday, weeks are ISO."""
    day = F.col("date")
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def latest_payments(payments: DataFrame) -> DataFrame:
    """Newest completed payment per booking (ties: highest id, then amount, then method)."""
    done = payments.where(F.col("status") == "completed").select(
        "booking_id", "payment_id", "payment_date", "amount", "payment_method"
    )
    newest = dedup_latest(
        done, ["booking_id"], [F.desc("payment_date"), F.desc("payment_id"), F.desc("amount"), F.desc("payment_method")]
    )
    return newest.select("booking_id", F.col("amount").alias("payment_amount"), "payment_method")


# What the booking facts read of a booking.
BOOKED_COLUMNS = (
    "booking_id", "user_id", "property_id", "check_in", "check_out", "guests_count", "total_amount", "status", "created_at", "updated_at",
)


def paid_bookings(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per booking with its newest completed payment.

    Both sides are already partitioned by the booking, so the join adds no shuffle.
    The booking facts start from this table; written once, it spares a second pass
    over bookings and payments. It holds no column that they don't read: the hashed
    business key alone would be half of its bytes.
    """
    newest = dedup_latest(bookings, ["booking_id"], [F.desc("processed_timestamp"), F.desc("updated_at")]).select(*BOOKED_COLUMNS)
    return newest.join(latest_payments(payments), "booking_id", "left")


def fact_booking_detail(paid: DataFrame, users: DataFrame, properties: DataFrame) -> DataFrame:
    """One row per paid booking (see :func:`paid_bookings`) with dimension keys."""
    joined = (
        paid.join(properties.select("property_id", "host_id", "destination_id"), "property_id", "left")
        .join(users.select("user_id", "is_business"), "user_id", "left")
    )
    cancelled = F.coalesce(F.col("status") == "cancelled", F.lit(False))
    return joined.select(
        "booking_id",
        "user_id",
        "host_id",
        "property_id",
        "destination_id",
        F.col("check_in").cast("date").alias("check_in_date"),
        F.col("check_out").cast("date").alias("check_out_date"),
        "guests_count",
        F.datediff("check_out", "check_in").alias("nights_booked"),
        F.col("total_amount").cast(MONEY).alias("total_amount"),
        F.col("payment_amount").cast(MONEY).alias("payment_amount"),
        "payment_method",
        "status",
        "created_at",
        "updated_at",
        F.datediff("check_in", "created_at").alias("days_between_booking_and_checkin"),
        cancelled.alias("is_cancelled"),
        F.coalesce("is_business", F.lit(False)).alias("is_business_booking"),
    )


def fact_booking_daily(paid_rows: DataFrame, properties: DataFrame) -> DataFrame:
    """One row per property and check-in date.

    The destination is an attribute of the property: it is looked up after the
    aggregation, so a property with very many bookings is reduced on the map side and
    never meets a join row by row. Every booking counts once: payments are reduced to
    one per booking before they are joined.
    """
    status = F.col("status")
    paid = F.count("payment_amount")
    per_day = (
        paid_rows.where(F.col("property_id").isNotNull())
        .withColumns(
            {"check_in_date": F.col("check_in").cast("date"), "nights": F.datediff("check_out", "check_in")}
        )
        .groupBy("property_id", "check_in_date")
        .agg(
            F.count("booking_id").alias("booking_count"),
            F.count_if(status == "confirmed").alias("confirmed_booking_count"),
            F.count_if(status == "cancelled").alias("cancellation_count"),
            F.sum("total_amount").cast(MONEY).alias("total_booking_value"),
            F.avg("total_amount").cast(MONEY).alias("avg_booking_value"),
            F.sum(F.col("guests_count").cast("long")).alias("total_guests"),
            F.avg("nights").cast("decimal(10,2)").alias("avg_nights_booked"),
            (paid * 100 / F.count("booking_id")).cast("decimal(5,2)").alias("payment_completion_rate"),
        )
    )
    return per_day.join(properties.select("property_id", "destination_id"), "property_id", "left").select(*FACT_BOOKING_DAILY.names)


def fact_property_engagement(page_views: DataFrame, clickstream: DataFrame, booking_daily: DataFrame) -> DataFrame:
    """Views, viewers, clicks and searches per property and day, with view-to-booking conversion.

    Rows without a property are left out (they could never match). The conversion
    rate is bookings checked in that day over views; NULL without views. Time on page
    is not delivered by the sources and stays NULL.
    """
    day = F.col("timestamp").cast("date").alias("engagement_date")
    keys = ["property_id", "engagement_date"]
    views = (
        page_views.where("property_id IS NOT NULL")
        .select("property_id", day, "view_id", "user_id")
        .groupBy(*keys)
        .agg(F.count("view_id").alias("view_count"), F.countDistinct("user_id").alias("unique_user_views"))
    )
    event = F.col("event")
    clicks = (
        clickstream.where("property_id IS NOT NULL")
        .select("property_id", day, "event")
        .groupBy(*keys)
        .agg(F.count_if(event == "click").alias("click_count"), F.count_if(event == "search").alias("search_count"))
    )
    booked = booking_daily.select("property_id", F.col("check_in_date").alias("engagement_date"), "booking_count")
    none = F.lit(0).cast("long")
    both = views.join(clicks, keys, "full_outer").select(
        *keys, *[F.coalesce(c, none).alias(c) for c in ("view_count", "unique_user_views", "click_count", "search_count")]
    )
    rate = F.coalesce(F.col("booking_count"), none) * 100 / F.nullif(F.col("view_count"), none)
    return both.join(booked, keys, "left").select(
        *both.columns,
        rate.cast("decimal(10,2)").alias("conversion_rate"),
        F.lit(None).cast("decimal(10,2)").alias("avg_time_on_page"),
    )


def dim_weather_location(silver: DataFrame) -> DataFrame:
    newest = dedup_latest(silver, ["locationKey"], [F.desc("processed_timestamp"), F.asc("localizedName")])
    return newest.select(
        F.md5("locationKey").alias("location_key"),
        "locationKey",
        "localizedName",
        "englishName",
        F.col("country.id").alias("country_code"),
        F.col("country.localizedName").alias("country_name"),
        F.col("administrativeArea.id").alias("administrativeArea_id"),
        F.col("administrativeArea.localizedName").alias("administrativeArea_name"),
        F.col("timeZone.code").alias("timezone_code"),
        F.col("timeZone.name").alias("timezone_name"),
        F.col("timeZone.gmtOffset").alias("gmt_offset"),
        F.col("geoPosition.latitude").alias("latitude"),
        F.col("geoPosition.longitude").alias("longitude"),
        F.col("geoPosition.elevation.metric.value").alias("elevation_metric_value"),
    )


def fact_weather_daily(silver: DataFrame) -> DataFrame:
    """One row per location and day: the newest issue of the nested forecast, flattened."""
    newest = dedup_latest(
        silver, ["locationKey", "date"], [F.desc("processed_timestamp"), F.desc("epochDate")]
    )
    nested = {
        "temperatureMin": "temperature.minimum.value",
        "temperatureMax": "temperature.maximum.value",
        "temperatureUnit": "temperature.minimum.unit",
        "realFeelMin": "realFeelTemperature.minimum.value",
        "realFeelMax": "realFeelTemperature.maximum.value",
        "day_iconPhrase": "day.iconPhrase",
        "day_hasPrecipitation": "day.hasPrecipitation",
        "night_iconPhrase": "night.iconPhrase",
        "night_hasPrecipitation": "night.hasPrecipitation",
    }
    return newest.select(
        "locationKey",
        F.md5("locationKey").alias("location_key"),
        "date",
        "epochDate",
        *[F.col(path).alias(name) for name, path in nested.items()],
        "hoursOfSun",
        "precipitationProbability",
        "thunderstormProbability",
        "rainProbability",
        "snowProbability",
        "iceProbability",
        "temperature_range",
        "is_precipitation_expected",
    )
