"""Host reports: bookings to listing to host, each step a sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.functions.shared import bookings_by, count_sum, current, days_between, label_order, mean, percent, ratio, total
from innsight.operators.ordered import top_ranked

# Placeholder response rates and the activity labels.
RESPONSE_RATE_VERIFIED, RESPONSE_RATE_OTHER = 95.0, 85.0
STATUS_LABELS = ["Active with Bookings", "Active without Bookings", "Inactive/Churned"]


def host_totals(dim_host: DataFrame, dim_property: DataFrame, detail: DataFrame, start: str, end: str) -> DataFrame:
    """Current hosts with listing and booking totals; hosts without listings are kept."""
    listed = current(dim_property).select("property_id", "host_id").join(
        bookings_by(detail, "property_id", start, end), "property_id", "left"
    )
    per_host = listed.groupBy("host_id").agg(
        F.count(F.lit(1)).alias("property_count"), count_sum("bookings").alias("bookings"), F.sum("revenue").alias("revenue"),
        count_sum("cancelled").alias("cancelled"),
    )
    none = F.lit(0).cast("long")
    return current(dim_host).join(per_host, "host_id", "left").withColumns(
        {c: F.coalesce(c, none) for c in ("property_count", "bookings", "cancelled")}
    )


def get_host_performance(
    dim_host: DataFrame, dim_property: DataFrame, detail: DataFrame, start: str, end: str, host_id: int | None = None
) -> DataFrame:
    if host_id is not None:
        dim_host = dim_host.where(F.col("host_id") == host_id)
    occupancy = percent("bookings", days_between(start, end) * F.col("property_count"))
    cancelled = percent("cancelled", "bookings")
    revenue = F.col("revenue").cast("double")
    score = F.col("rating") / 5 * 30 + revenue / 50000 * 40 + occupancy / 100 * 20 + (100 - cancelled) / 100 * 10
    return host_totals(dim_host, dim_property, detail, start, end).select(
        "host_id", F.col("name").alias("host_name"), "country", "is_verified", "rating", "property_count",
        F.col("bookings").alias("total_bookings"), revenue.alias("total_revenue"), ratio("revenue", "bookings").alias("avg_booking_value"),
        occupancy.alias("avg_occupancy_rate"), cancelled.alias("cancellation_rate"), score.alias("host_performance_score"),
    ).orderBy(F.desc_nulls_last("host_performance_score"), "host_id")


def get_host_quality_metrics(
    dim_host: DataFrame, dim_property: DataFrame, detail: DataFrame, start: str, end: str, top_n: int = 20
) -> DataFrame:
    verified = F.col("is_verified")
    response = F.when(verified, RESPONSE_RATE_VERIFIED).otherwise(RESPONSE_RATE_OTHER)
    cancelled = percent("cancelled", "bookings")
    score = F.col("rating") / 5 * 40 + response / 100 * 30 + (100 - cancelled) / 100 * 20 + F.when(verified, 10).otherwise(0)
    scored = host_totals(dim_host, dim_property, detail, start, end).select(
        "host_id", F.col("name").alias("host_name"), "is_verified", "rating", "property_count", F.col("bookings").alias("total_bookings"),
        response.alias("response_rate"), cancelled.alias("cancellation_by_host_rate"), score.alias("quality_score"),
    )
    return top_ranked(scored, top_n, [F.desc_nulls_last("quality_score"), F.asc("host_id")]).orderBy("rank")


def get_host_retention_analysis(dim_host: DataFrame, dim_property: DataFrame, detail: DataFrame, start: str, end: str) -> DataFrame:
    active, booked = F.col("is_active"), F.col("bookings") > 0
    status = F.when(active & booked, STATUS_LABELS[0]).when(active, STATUS_LABELS[1]).otherwise(STATUS_LABELS[2])
    return (
        host_totals(dim_host, dim_property, detail, start, end)
        .withColumn("host_status", status)
        .groupBy("host_status")
        .agg(
            F.count(F.lit(1)).alias("host_count"), count_sum("property_count").alias("total_properties"),
            count_sum("bookings").alias("total_bookings"), total("revenue").alias("total_revenue"),
            ratio(F.sum("property_count"), F.count(F.lit(1))).alias("avg_properties_per_host"),
            ratio(F.sum("revenue"), F.count(F.lit(1))).alias("avg_revenue_per_host"),
            mean("rating").alias("avg_rating"),
        )
        .orderBy(label_order("host_status", STATUS_LABELS))
    )


def get_host_geographic_distribution(
    dim_host: DataFrame, dim_property: DataFrame, detail: DataFrame, start: str, end: str, top_n: int | None = None
) -> DataFrame:
    """Per country. Every host counts once in the verified count and the mean rating."""
    per_country = host_totals(dim_host, dim_property, detail, start, end).groupBy("country").agg(
        F.count(F.lit(1)).alias("host_count"), F.count_if("is_verified").alias("verified_host_count"),
        percent(F.count_if("is_verified"), F.count(F.lit(1))).alias("verification_rate"),
        count_sum("property_count").alias("total_properties"), count_sum("bookings").alias("total_bookings"),
        total("revenue").alias("total_revenue"), mean("rating").alias("avg_rating"),
        ratio(F.sum("revenue"), F.count(F.lit(1))).alias("avg_revenue_per_host"),
    )
    return top_ranked(per_country, top_n, [F.desc("host_count"), F.asc("country")]).orderBy("rank")


def get_multi_property_hosts(
    dim_host: DataFrame, dim_property: DataFrame, detail: DataFrame, start: str, end: str, min_properties: int = 3
) -> DataFrame:
    occupancy = percent("bookings", days_between(start, end) * F.col("property_count"))
    revenue = F.col("revenue").cast("double")
    return (
        host_totals(dim_host, dim_property, detail, start, end)
        .where(F.col("property_count") >= min_properties)
        .select(
            "host_id", F.col("name").alias("host_name"), "country", "property_count", F.col("bookings").alias("total_bookings"),
            revenue.alias("total_revenue"), ratio("revenue", "property_count").alias("avg_revenue_per_property"),
            occupancy.alias("avg_occupancy_rate"),
            (revenue / 100000 * 50 + occupancy / 100 * 30 + F.col("property_count") / 10 * 20).alias("portfolio_performance_score"),
        )
        .orderBy(F.desc_nulls_last("portfolio_performance_score"), "host_id")
    )
