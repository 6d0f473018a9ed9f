"""Revenue reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.functions.shared import (
    count_sum, current, days_between, destination_labels, in_range, percent, period_name, period_start, place, ratio, total,
)
from innsight.operators.ordered import top_ranked


def get_revenue_by_period(daily: DataFrame, start: str, end: str, grain: str = "day") -> DataFrame:
    """Revenue and booking counts per day, week, month, quarter or year.

    ``unique_guests`` is the sum of guests, as the report has always defined it.
    Properties are counted by grouping twice, so no row is expanded for the distinct.
    """
    per_property = (
        daily.where(in_range("check_in_date", start, end))
        .groupBy(period_start(grain, "check_in_date").alias("period_start"), "property_id")
        .agg(
            F.sum("total_booking_value").alias("value"),
            F.sum("booking_count").alias("bookings"),
            F.sum("confirmed_booking_count").alias("confirmed"),
            F.sum("cancellation_count").alias("cancelled"),
            F.sum("total_guests").alias("guests"),
        )
    )
    return (
        per_property.groupBy("period_start")
        .agg(
            total("value").alias("total_revenue"),
            count_sum("bookings").alias("booking_count"),
            count_sum("confirmed").alias("confirmed_bookings"),
            count_sum("cancelled").alias("cancellation_count"),
            F.count("property_id").alias("unique_properties"),
            count_sum("guests").alias("unique_guests"),
        )
        .select(
            "period_start",
            period_name(grain, "period_start").alias("period_name"),
            "total_revenue",
            "booking_count",
            ratio("total_revenue", "booking_count").alias("avg_booking_value"),
            "confirmed_bookings",
            "cancellation_count",
            percent("cancellation_count", "booking_count").alias("cancellation_rate"),
            "unique_properties",
            "unique_guests",
        )
        .orderBy("period_start")
    )


def get_top_properties_by_revenue(
    daily: DataFrame, dim_property: DataFrame, dim_destination: DataFrame, dim_host: DataFrame, start: str, end: str, top_n: int = 10
) -> DataFrame:
    """Best properties by revenue. Ranked on the fact alone; only the winners meet the dimensions."""
    per_property = (
        daily.where(in_range("check_in_date", start, end))
        .groupBy("property_id")
        .agg(
            F.max("destination_id").alias("destination_id"),
            total("total_booking_value").alias("total_revenue"),
            count_sum("booking_count").alias("booking_count"),
            total(F.col("avg_nights_booked") * F.col("booking_count")).alias("total_nights"),
        )
    )
    best = top_ranked(per_property, top_n, [F.desc("total_revenue"), F.asc("property_id")])
    owners = current(dim_host).select("host_id", F.col("name").alias("host_name"))
    listings = current(dim_property).select("property_id", "host_id", F.col("title").alias("property_title"), "property_type")
    return (
        best.join(listings, "property_id", "left")
        .join(destination_labels(dim_destination), "destination_id", "left")
        .join(owners, "host_id", "left")
        .select(
            "rank", "property_id", "property_title", "destination", "property_type", "host_name", "total_revenue",
            "booking_count",
            ratio("total_revenue", "booking_count").alias("avg_revenue_per_booking"),
            "total_nights",
            percent("booking_count", days_between(start, end)).alias("avg_occupancy_rate"),
        )
        .orderBy("rank")
    )


def get_revenue_by_destination(daily: DataFrame, dim_destination: DataFrame, start: str, end: str, top_n: int | None = None) -> DataFrame:
    per_property = (
        daily.where(in_range("check_in_date", start, end))
        .groupBy("destination_id", "property_id")
        .agg(
            F.sum("total_booking_value").alias("value"), F.sum("booking_count").alias("bookings"), F.sum("total_guests").alias("guests")
        )
    )
    per_destination = per_property.groupBy("destination_id").agg(
        F.count("property_id").alias("property_count"),
        total("value").alias("total_revenue"),
        count_sum("bookings").alias("booking_count"),
        ratio(F.sum("value"), F.count("property_id")).alias("avg_revenue_per_property"),
        count_sum("guests").alias("unique_guests"),
    )
    best = top_ranked(per_destination, top_n, [F.desc("total_revenue"), F.asc("destination_id")])
    names = dim_destination.select("destination_id", "destination", "state_or_province", "country")
    return best.join(names, "destination_id", "left").select(
        "rank", "destination_id", "destination", "state_or_province", "country", "property_count", "total_revenue",
        "booking_count", "avg_revenue_per_property", "unique_guests",
    ).orderBy("rank")


def get_payment_metrics(detail: DataFrame, start: str, end: str) -> DataFrame:
    paid = F.coalesce("payment_amount", F.lit(0).cast("decimal(18,2)"))
    rows = F.count(F.lit(1))
    return (
        detail.where(in_range("check_in_date", start, end))
        .groupBy(F.coalesce("payment_method", F.lit("Unpaid/Pending")).alias("payment_method"))
        .agg(
            rows.alias("booking_count"),
            total(paid).alias("total_payment_amount"),
            ratio(F.sum(paid), rows).alias("avg_payment_amount"),
            percent(F.count("payment_amount"), rows).alias("payment_completion_rate"),
            total("total_amount").alias("total_booking_value"),
        )
        .orderBy(F.desc("total_payment_amount"), "payment_method")
    )


def get_cancellation_analysis(detail: DataFrame, dim_destination: DataFrame, start: str, end: str) -> DataFrame:
    amount, zero = F.col("total_amount"), F.lit(0).cast("decimal(18,2)")
    confirmed, cancelled = F.col("status") == "confirmed", F.col("is_cancelled")
    per_destination = (
        detail.where(in_range("check_in_date", start, end))
        .groupBy("destination_id")
        .agg(
            F.count(F.lit(1)).alias("total_bookings"),
            F.count_if(confirmed).alias("confirmed_bookings"),
            F.count_if(cancelled).alias("cancelled_bookings"),
            F.sum(amount).alias("potential"),
            F.sum(F.when(confirmed, amount).otherwise(zero)).alias("actual"),
            F.sum(F.when(cancelled, amount).otherwise(zero)).alias("lost"),
        )
    )
    labelled = per_destination.join(destination_labels(dim_destination), "destination_id", "left").groupBy("destination").agg(
        *[count_sum(c).alias(c) for c in ("total_bookings", "confirmed_bookings", "cancelled_bookings")],
        total("potential").alias("potential_revenue"),
        total("actual").alias("actual_revenue"),
        total("lost").alias("lost_revenue"),
    )
    return labelled.select(
        "destination", "total_bookings", "confirmed_bookings", "cancelled_bookings",
        percent("cancelled_bookings", "total_bookings").alias("cancellation_rate"),
        "potential_revenue", "actual_revenue", "lost_revenue",
    ).orderBy(F.desc("lost_revenue"), "destination")


def get_revenue_forecast_inputs(
    daily: DataFrame, dim_date: DataFrame, start: str, end: str, property_id: int | None = None
) -> DataFrame:
    """Daily series (ds, y) per property with calendar features.

    The calendar has one row per day, so Spark broadcasts it.
    """
    rows = daily.where(in_range("check_in_date", start, end))
    if property_id is not None:
        rows = rows.where(F.col("property_id") == property_id)
    calendar = dim_date.select(F.col("date").alias("check_in_date"), "is_weekend")
    day = F.col("check_in_date")
    return (
        rows.join(calendar, "check_in_date", "left")
        .select(
            day.alias("ds"), "property_id", F.col("total_booking_value").cast("double").alias("y"), "booking_count",
            F.col("avg_booking_value").cast("double").alias("avg_booking_value"),
            F.dayofweek(day).alias("day_of_week"), "is_weekend", F.month(day).alias("month"), F.quarter(day).alias("quarter"),
        )
        .orderBy("ds", "property_id")
    )
