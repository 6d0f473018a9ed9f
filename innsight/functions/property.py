"""Listing reports. Facts are reduced to the property first; listings then add up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.functions.shared import (
    bookings_by, bucket, count_sum, current, days_between, destination_labels, engagement_by_property, label_order, mean, percent,
    ratio, total,
)
from innsight.operators.ordered import top_ranked

# Price ranges of the pricing report (half-open).
PRICE_CUTS = [(100, "$0-$99"), (200, "$100-$199"), (300, "$200-$299"), (500, "$300-$499")]
PRICE_LAST = "$500+"


def _listed(dim_property: DataFrame, detail: DataFrame, start: str, end: str) -> DataFrame:
    """Current listings with their booking totals (zero bookings kept)."""
    return current(dim_property).join(bookings_by(detail, "property_id", start, end), "property_id", "left").withColumn(
        "bookings", F.coalesce("bookings", F.lit(0))
    )


def _occupancy(bookings: Column, properties: Column, start: str, end: str) -> Column:
    """Bookings per listing-day in percent (bookings, not nights, by definition of the report)."""
    return percent(bookings, days_between(start, end) * properties)


def get_property_performance(
    dim_property: DataFrame, dim_destination: DataFrame, detail: DataFrame, engagement: DataFrame, start: str, end: str,
    destination: str | None = None,
) -> DataFrame:
    seen = engagement_by_property(engagement, start, end).select(
        "property_id", ratio("conversion_sum", "conversion_days").alias("conversion_rate"), F.col("views").alias("total_views")
    )
    listed = _listed(dim_property, detail, start, end).join(destination_labels(dim_destination), "destination_id", "left")
    if destination is not None:
        listed = listed.where(F.col("destination") == destination)
    occupancy = percent("bookings", days_between(start, end))
    revenue = F.col("revenue").cast("double")
    score = revenue / 100000 * 40 + occupancy / 100 * 30 + F.col("conversion_rate") / 5 * 30
    return (
        listed.join(seen, "property_id", "left")
        .select(
            "property_id", F.col("title").alias("property_title"), "property_type", "destination",
            F.col("base_price").cast("double").alias("base_price"), F.col("bookings").alias("total_bookings"),
            revenue.alias("total_revenue"), occupancy.alias("avg_occupancy_rate"),
            ratio("revenue", "bookings").alias("avg_booking_value"), F.col("nights").alias("total_nights"),
            "conversion_rate", "total_views", score.alias("property_score"),
        )
        .orderBy(F.desc_nulls_last("property_score"), "property_id")
    )


def get_availability_by_destination(
    dim_destination: DataFrame, dim_property: DataFrame, detail: DataFrame, start: str, end: str, top_n: int | None = None
) -> DataFrame:
    per_destination = _listed(dim_property, detail, start, end).groupBy("destination_id").agg(
        F.count(F.lit(1)).alias("total_properties"),
        F.count_if(F.col("bookings") > 0).alias("active_properties"),
        count_sum("bookings").alias("total_bookings"),
        total("revenue").alias("total_revenue"),
        mean("base_price").alias("avg_price"),
    )
    none = F.lit(0).cast("long")
    per_label = destination_labels(dim_destination).join(per_destination, "destination_id", "left").select(
        "destination",
        *[F.coalesce(c, none).alias(c) for c in ("total_properties", "active_properties", "total_bookings")],
        _occupancy(F.coalesce("total_bookings", none), F.col("total_properties"), start, end).alias("avg_occupancy_rate"),
        "total_revenue", "avg_price",
        percent("active_properties", "total_properties").alias("inventory_utilization"),
    )
    return top_ranked(per_label, top_n, [F.desc("total_properties"), F.asc("destination")]).orderBy("rank")


def get_property_type_analysis(
    dim_property: DataFrame, detail: DataFrame, engagement: DataFrame, start: str, end: str
) -> DataFrame:
    """Per type, with each type's share of revenue (the window sees one row per type)."""
    seen = engagement_by_property(engagement, start, end).select("property_id", "conversion_sum", "conversion_days")
    per_type = (
        _listed(dim_property, detail, start, end)
        .join(seen, "property_id", "left")
        .groupBy("property_type")
        .agg(
            F.count(F.lit(1)).alias("property_count"), count_sum("bookings").alias("total_bookings"),
            F.sum("revenue").alias("revenue"), F.sum("nights").alias("nights"),
            F.sum("conversion_sum").alias("conversion_sum"), F.sum("conversion_days").alias("conversion_days"),
        )
    )
    grand = F.sum("revenue").over(Window.partitionBy())
    return per_type.select(
        "property_type", "property_count", "total_bookings", F.col("revenue").cast("double").alias("total_revenue"),
        ratio("revenue", "total_bookings").alias("avg_booking_value"),
        ratio("nights", "total_bookings").alias("avg_nights_per_booking"),
        _occupancy(F.col("total_bookings"), F.col("property_count"), start, end).alias("avg_occupancy_rate"),
        ratio("conversion_sum", "conversion_days").alias("conversion_rate"),
        percent("revenue", grand).alias("market_share_revenue"),
    ).orderBy(F.desc("total_revenue"), "property_type")


def get_amenity_impact(dim_property: DataFrame, detail: DataFrame, start: str, end: str, min_properties: int = 3) -> DataFrame:
    """Per (bedrooms, bathrooms, guests) configuration with enough listings."""
    per_config = (
        _listed(dim_property, detail, start, end)
        .groupBy("bedrooms", "bathrooms", "max_guests")
        .agg(
            F.count(F.lit(1)).alias("property_count"), count_sum("bookings").alias("bookings"), F.sum("revenue").alias("revenue"),
            mean("base_price").alias("avg_price"),
        )
        .where(F.col("property_count") >= min_properties)
    )
    per_listing = ratio("revenue", "property_count")
    occupancy = _occupancy(F.col("bookings"), F.col("property_count"), start, end)
    return per_config.select(
        "bedrooms", "bathrooms", "max_guests", "property_count", ratio("bookings", "property_count").alias("avg_booking_count"),
        per_listing.alias("avg_revenue_per_property"), "avg_price", occupancy.alias("avg_occupancy_rate"),
        (per_listing / 10000 * 50 + occupancy / 100 * 50).alias("performance_score"),
    ).orderBy(F.desc_nulls_last("performance_score"), "bedrooms", "bathrooms", "max_guests")


def get_pricing_analysis(dim_property: DataFrame, detail: DataFrame, engagement: DataFrame, start: str, end: str) -> DataFrame:
    """Five price ranges. Ranges are half-open, so 199.50 belongs to the range below 200."""
    seen = engagement_by_property(engagement, start, end).select(
        "property_id", ratio("conversion_sum", "conversion_days").alias("conversion_rate")
    )
    per_bucket = (
        _listed(dim_property, detail, start, end)
        .join(seen, "property_id", "left")
        .withColumn("price_bucket", bucket(F.col("base_price"), PRICE_CUTS, PRICE_LAST))
        .groupBy("price_bucket")
        .agg(
            F.count(F.lit(1)).alias("property_count"), count_sum("bookings").alias("total_bookings"), F.sum("revenue").alias("revenue"),
            F.avg("conversion_rate").alias("avg_conversion_rate"),
        )
    )
    per_listing = ratio("revenue", "property_count")
    occupancy = _occupancy(F.col("total_bookings"), F.col("property_count"), start, end)
    return per_bucket.select(
        "price_bucket", "property_count", "total_bookings", F.col("revenue").cast("double").alias("total_revenue"),
        occupancy.alias("avg_occupancy_rate"), F.round("avg_conversion_rate", 6).alias("avg_conversion_rate"),
        per_listing.alias("revenue_per_property"),
        (per_listing / 10000 * 60 + occupancy / 100 * 40).alias("price_efficiency_score"),
    ).orderBy(label_order("price_bucket", [name for _, name in PRICE_CUTS] + [PRICE_LAST]))
