"""Engagement reports.

Engagement and bookings are each reduced to the property before they meet, so
neither multiplies the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.functions.shared import (
    bookings_on_engaged_days, count_sum, current, destination_labels, engagement_by_property, in_range, percent, period_name,
    period_start, ratio,
)
from innsight.operators.ordered import top_ranked

_SUMS = ("views", "viewers", "clicks", "searches", "conversion_sum", "conversion_days", "time_sum", "days")


def _listings(dim_property: DataFrame, *columns: str) -> DataFrame:
    return current(dim_property).select("property_id", *columns)


def _rates(df: DataFrame) -> DataFrame:
    """Averages over property-days from the carried sums; no recorded time counts as zero."""
    return df.withColumns(
        {
            "conversion_rate": ratio("conversion_sum", "conversion_days"),
            "avg_time_on_page": ratio("time_sum", "days"),
            "click_ratio": ratio("clicks", "views"),
        }
    )


def get_property_engagement(
    engagement: DataFrame, dim_property: DataFrame, dim_destination: DataFrame, start: str, end: str, property_id: int | None = None
) -> DataFrame:
    if property_id is not None:
        engagement = engagement.where(F.col("property_id") == property_id)
    per_property = _rates(engagement_by_property(engagement, start, end))
    score = F.col("click_ratio") * 50 + F.col("avg_time_on_page") / 60 * 50
    return (
        per_property.join(_listings(dim_property, F.col("title").alias("property_title"), "property_type", "destination_id"), "property_id", "left")
        .join(destination_labels(dim_destination), "destination_id", "left")
        .select(
            "property_id", "property_title", "property_type", "destination",
            F.col("views").alias("total_views"), F.col("viewers").alias("unique_viewers"),
            F.col("clicks").alias("total_clicks"), F.col("searches").alias("search_appearances"),
            "conversion_rate", "avg_time_on_page", score.alias("engagement_score"),
        )
        .orderBy(F.desc("engagement_score"), "property_id")
    )


def _summed(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in _SUMS], count_sum("booked").alias("booked"))


def _with_bookings(engagement: DataFrame, daily: DataFrame, start: str, end: str) -> DataFrame:
    booked = bookings_on_engaged_days(engagement, daily, start, end)
    return engagement_by_property(engagement, start, end).join(booked, "property_id", "left")


def get_conversion_funnel(
    engagement: DataFrame, daily: DataFrame, dim_property: DataFrame, dim_destination: DataFrame, start: str, end: str,
    destination: str | None = None,
) -> DataFrame:
    labelled = (
        _with_bookings(engagement, daily, start, end)
        .join(_listings(dim_property, "destination_id"), "property_id", "left")
        .join(destination_labels(dim_destination), "destination_id", "left")
    )
    if destination is not None:
        labelled = labelled.where(F.col("destination") == destination)
    return (
        _summed(labelled, "destination")
        .where("views > 0")
        .select(
            "destination",
            F.col("views").alias("total_views"), F.col("clicks").alias("total_clicks"), F.col("booked").alias("total_bookings"),
            percent("clicks", "views").alias("view_to_click_rate"),
            percent("booked", "clicks").alias("click_to_booking_rate"),
            percent("booked", "views").alias("overall_conversion_rate"),
            (ratio("clicks", "views") * 50 + ratio("booked", "clicks") * 50).alias("funnel_efficiency"),
        )
        .orderBy(F.desc("overall_conversion_rate"), "destination")
    )


def get_traffic_source_analysis(engagement: DataFrame, daily: DataFrame, dim_property: DataFrame, start: str, end: str) -> DataFrame:
    typed = _with_bookings(engagement, daily, start, end).join(_listings(dim_property, "property_type"), "property_id", "left")
    return (
        _rates(_summed(typed, "property_type"))
        .where("views > 0")
        .select(
            "property_type", F.col("views").alias("total_views"), F.col("viewers").alias("unique_viewers"),
            F.col("clicks").alias("total_clicks"), "avg_time_on_page", "conversion_rate", F.col("booked").alias("bookings_generated"),
        )
        .orderBy(F.desc("bookings_generated"), "property_type")
    )


def get_engagement_trends(engagement: DataFrame, start: str, end: str, grain: str = "day") -> DataFrame:
    spent = F.coalesce("avg_time_on_page", F.lit(0).cast("decimal(10,2)"))
    per_property = (
        engagement.where(in_range("engagement_date", start, end))
        .groupBy(period_start(grain, "engagement_date").alias("period_start"), "property_id")
        .agg(
            F.sum("view_count").alias("views"), F.sum("click_count").alias("clicks"),
            F.sum("conversion_rate").alias("conversion_sum"), F.count("conversion_rate").alias("conversion_days"),
            F.sum(spent).alias("time_sum"), F.count(F.lit(1)).alias("days"),
        )
    )
    per_period = _rates(
        per_property.groupBy("period_start").agg(
            *[F.sum(c).alias(c) for c in ("views", "clicks", "conversion_sum", "conversion_days", "time_sum", "days")],
            F.count("property_id").alias("unique_properties_viewed"),
        )
    )
    index = F.col("click_ratio") * 40 + F.col("conversion_rate") / 5 * 30 + F.col("avg_time_on_page") / 60 * 30
    return per_period.select(
        "period_start", period_name(grain if grain in ("day", "week") else "day", "period_start").alias("period_name"),
        F.col("views").alias("total_views"), F.col("clicks").alias("total_clicks"),
        F.col("conversion_rate").alias("avg_conversion_rate"), "avg_time_on_page", "unique_properties_viewed",
        index.alias("engagement_index"),
    ).orderBy("period_start")


def get_top_engaging_properties(
    engagement: DataFrame, daily: DataFrame, dim_property: DataFrame, dim_destination: DataFrame, start: str, end: str, top_n: int = 10
) -> DataFrame:
    scored = _rates(_with_bookings(engagement, daily, start, end)).select(
        "property_id", F.col("views").alias("total_views"), (F.col("click_ratio") * 100).alias("click_through_rate"),
        "conversion_rate", "avg_time_on_page",
        (F.col("click_ratio") * 30 + F.col("conversion_rate") / 5 * 40 + F.col("avg_time_on_page") / 60 * 30).alias("engagement_score"),
        F.coalesce("booked", F.lit(0)).alias("bookings_generated"),
    )
    best = top_ranked(scored, top_n, [F.desc_nulls_last("engagement_score"), F.asc("property_id")])
    return (
        best.join(_listings(dim_property, F.col("title").alias("property_title"), "destination_id"), "property_id", "left")
        .join(destination_labels(dim_destination), "destination_id", "left")
        .select(
            "rank", "property_id", "property_title", "destination", "total_views", "click_through_rate", "conversion_rate",
            "avg_time_on_page", "engagement_score", "bookings_generated",
        )
        .orderBy("rank")
    )
