"""Customer reports. Bookings are reduced to the customer once; every customer counts once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.functions.shared import (
    bookings_by, bucket, count_sum, current, in_range, label_order, mean, percent, ratio, total,
)
from innsight.operators.ordered import exact_quantiles, top_ranked

# Booking-count ranges and their labels.
SEGMENT_CUTS = [(1, "Inactive"), (2, "One-time Booker"), (4, "Repeat Customer"), (7, "Frequent Traveler")]
SEGMENT_LAST = "VIP Customer"
FREQUENCY_CUTS = [(1, "No Bookings"), (2, "1 Booking"), (4, "2-3 Bookings"), (7, "4-6 Bookings")]
FREQUENCY_LAST = "7+ Bookings"
VIP_QUANTILE = 0.95


def customer_totals(dim_user: DataFrame, detail: DataFrame, start: str, end: str) -> DataFrame:
    none = F.lit(0).cast("long")
    return current(dim_user).join(bookings_by(detail, "user_id", start, end), "user_id", "left").withColumns(
        {c: F.coalesce(c, none) for c in ("bookings", "cancelled")}
    )


def _grand(column: str) -> Column:
    """Total over the grouped rows (a handful), for shares."""
    return F.sum(column).over(Window.partitionBy())


def get_customer_segments(dim_user: DataFrame, detail: DataFrame, start: str, end: str) -> DataFrame:
    per_segment = (
        customer_totals(dim_user, detail, start, end)
        .withColumn("segment_name", bucket(F.col("bookings"), SEGMENT_CUTS, SEGMENT_LAST))
        .groupBy("segment_name")
        .agg(
            F.count(F.lit(1)).alias("customer_count"), count_sum("bookings").alias("total_bookings"), F.sum("revenue").alias("revenue"),
            F.sum("nights").alias("nights"), count_sum("cancelled").alias("cancelled"),
        )
    )
    labels = [SEGMENT_LAST] + [name for _, name in reversed(SEGMENT_CUTS)]
    return per_segment.select(
        "segment_name", "customer_count", "total_bookings", F.col("revenue").cast("double").alias("total_revenue"),
        ratio("revenue", "total_bookings").alias("avg_booking_value"),
        ratio("total_bookings", "customer_count").alias("avg_bookings_per_customer"),
        percent("revenue", _grand("revenue")).alias("segment_revenue_share"),
        ratio("nights", "total_bookings").alias("avg_nights_per_booking"),
        percent("cancelled", "total_bookings").alias("cancellation_rate"),
    ).orderBy(label_order("segment_name", labels))


def get_customer_ltv(
    dim_user: DataFrame, detail: DataFrame, start: str, end: str, top_n: int = 100, as_of: str | None = None
) -> DataFrame:
    """Most valuable customers. Ranked before the user table joins."""
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    per_user = (
        detail.where(in_range("check_in_date", start, end))
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_bookings"), total("total_amount").alias("lifetime_value"),
            F.min("check_in_date").alias("first_booking_date"), F.max("check_in_date").alias("last_booking_date"),
        )
        .join(current(dim_user).select("user_id", "country", "user_type"), "user_id")
        .select(
            "user_id", "country", "user_type", "total_bookings", "lifetime_value",
            ratio("lifetime_value", "total_bookings").alias("avg_booking_value"), "first_booking_date", "last_booking_date",
            F.datediff(today, "last_booking_date").alias("days_since_last_booking"),
            F.datediff("last_booking_date", "first_booking_date").alias("customer_tenure_days"),
        )
    )
    return top_ranked(per_user, top_n, [F.desc("lifetime_value"), F.asc("user_id")]).orderBy("rank")


def get_booking_frequency_analysis(dim_user: DataFrame, detail: DataFrame, start: str, end: str) -> DataFrame:
    per_bucket = (
        customer_totals(dim_user, detail, start, end)
        .withColumn("booking_frequency_bucket", bucket(F.col("bookings"), FREQUENCY_CUTS, FREQUENCY_LAST))
        .groupBy("booking_frequency_bucket")
        .agg(F.count(F.lit(1)).alias("customer_count"), count_sum("bookings").alias("total_bookings"), F.sum("revenue").alias("revenue"))
    )
    labels = [FREQUENCY_LAST] + [name for _, name in reversed(FREQUENCY_CUTS)]
    return per_bucket.select(
        "booking_frequency_bucket", "customer_count", "total_bookings", F.col("revenue").cast("double").alias("total_revenue"),
        ratio("revenue", "total_bookings").alias("avg_booking_value"),
        percent("customer_count", _grand("customer_count")).alias("customer_percentage"),
        percent("revenue", _grand("revenue")).alias("revenue_percentage"),
    ).orderBy(label_order("booking_frequency_bucket", labels))


def get_customer_geographic_analysis(dim_user: DataFrame, detail: DataFrame, start: str, end: str, top_n: int | None = None) -> DataFrame:
    per_country = (
        customer_totals(dim_user, detail, start, end)
        .groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("customer_count"), count_sum("bookings").alias("total_bookings"), F.sum("revenue").alias("revenue"),
            count_sum("cancelled").alias("cancelled"),
        )
        .select(
            "country", "customer_count", "total_bookings", F.col("revenue").cast("double").alias("total_revenue"),
            ratio("total_bookings", "customer_count").alias("avg_bookings_per_customer"),
            ratio("revenue", "customer_count").alias("avg_revenue_per_customer"),
            ratio("revenue", "total_bookings").alias("avg_booking_value"),
            percent("cancelled", "total_bookings").alias("cancellation_rate"),
        )
    )
    return top_ranked(per_country, top_n, [F.desc("customer_count"), F.asc("country")]).orderBy("rank")


def get_business_vs_leisure_analysis(dim_user: DataFrame, detail: DataFrame, start: str, end: str) -> DataFrame:
    """Two rows by trip purpose. Distinct customers come from grouping by customer first."""
    known = current(dim_user).select("user_id", F.lit(1).alias("known"))
    per_user = (
        detail.where(in_range("check_in_date", start, end))
        .withColumn("booking_type", F.when(F.col("is_business_booking"), "Business").otherwise("Leisure"))
        .groupBy("booking_type", "user_id")
        .agg(
            F.count(F.lit(1)).alias("bookings"), F.sum("total_amount").alias("revenue"), F.sum("nights_booked").alias("nights"),
            F.sum("days_between_booking_and_checkin").alias("lead"), F.count_if("is_cancelled").alias("cancelled"),
            F.count("payment_amount").alias("paid"),
        )
        .join(known, "user_id", "left")
    )
    bookings = F.sum("bookings")
    return (
        per_user.groupBy("booking_type")
        .agg(
            F.count("known").alias("customer_count"), count_sum("bookings").alias("total_bookings"), total("revenue").alias("total_revenue"),
            ratio(F.sum("revenue"), bookings).alias("avg_booking_value"), ratio(F.sum("nights"), bookings).alias("avg_nights_booked"),
            ratio(F.sum("lead"), bookings).alias("avg_lead_time_days"), percent(F.sum("cancelled"), bookings).alias("cancellation_rate"),
            percent(F.sum("paid"), bookings).alias("payment_completion_rate"),
        )
        .orderBy("booking_type")
    )


def get_vip_customer_property_preferences(
    detail: DataFrame, dim_property: DataFrame, start: str = "2020-01-01", end: str = "2099-12-31"
) -> DataFrame:
    """Property types of the top 5 % spenders. The threshold is an exact distributed quantile."""
    rows = detail.where(in_range("check_in_date", start, end))
    spend = rows.groupBy("user_id").agg(total("total_amount").alias("spend"))
    threshold = exact_quantiles(spend, "spend", {"cut": VIP_QUANTILE}).scalar()
    vips = spend.where(F.col("spend") >= threshold).select("user_id")
    types = current(dim_property).where("property_type IS NOT NULL").select("property_id", "property_type")
    per_user = (
        rows.join(vips, "user_id", "left_semi")
        .join(types, "property_id")
        .groupBy("property_type", "user_id")
        .agg(F.count(F.lit(1)).alias("bookings"), F.sum("total_amount").alias("revenue"))
    )
    per_type = per_user.groupBy("property_type").agg(
        F.count(F.lit(1)).alias("vip_customer_count"), count_sum("bookings").alias("vip_bookings"), F.sum("revenue").alias("revenue")
    )
    return per_type.select(
        "property_type", "vip_customer_count", "vip_bookings", F.col("revenue").cast("double").alias("vip_revenue"),
        ratio("revenue", "vip_bookings").alias("avg_booking_value"),
        percent("revenue", _grand("revenue")).alias("pct_of_total_vip_revenue"),
    ).orderBy(F.desc("vip_customer_count"), "property_type")
