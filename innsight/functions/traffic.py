"""Traffic by referrer and device, and period-over-period comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.functions.shared import count_sum, in_range, percent, period_start, ratio, total


def _traffic(page_views: DataFrame, clickstream: DataFrame, view_key: str, click_key: str, name: str, start: str, end: str) -> DataFrame:
    """Views and clicks per attribute value; viewers are counted by grouping twice."""
    day = F.col("timestamp").cast("date")
    inside = day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    views = (
        page_views.where(inside).groupBy(F.col(view_key).alias(name), "user_id").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(name).agg(F.sum("n").alias("total_views"), F.count("user_id").alias("unique_viewers"))
    )
    event = F.col("event")
    clicks = clickstream.where(inside).groupBy(F.col(click_key).alias(name)).agg(
        F.count_if(event == "click").alias("total_clicks"), F.count_if(event == "search").alias("total_searches")
    )
    none = F.lit(0).cast("long")
    counted = views.join(clicks, name, "full_outer").select(
        name, *[F.coalesce(c, none).alias(c) for c in ("total_views", "unique_viewers", "total_clicks", "total_searches")]
    )
    return counted.withColumn("click_through_rate", percent("total_clicks", "total_views")).orderBy(F.desc("total_views"), name)


def get_traffic_by_referrer(page_views: DataFrame, clickstream: DataFrame, start: str, end: str) -> DataFrame:
    return _traffic(page_views, clickstream, "referrer", "referrer", "referrer", start, end)


def get_device_engagement(page_views: DataFrame, clickstream: DataFrame, start: str, end: str) -> DataFrame:
    return _traffic(page_views, clickstream, "device_type", "device", "device", start, end)


def kpi_vs_previous_period(detail: DataFrame, start: str, end: str) -> DataFrame:
    """Headline figures beside those of the equally long period just before; one scan for both."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    length = F.datediff(last, first) + 1
    day = F.col("check_in_date")
    rows = detail.where(day.between(F.date_sub(first, length), last))
    kpis: dict[str, Column] = {}
    for label, inside in (("current", day >= first), ("previous", day < first)):
        n = F.count_if(inside)
        kpis[f"{label}_revenue"] = F.coalesce(F.sum(F.when(inside, F.col("total_amount"))), F.lit(0)).cast("double")
        kpis[f"{label}_bookings"] = n.cast("double")
        kpis[f"{label}_avg_booking_value"] = ratio(F.sum(F.when(inside, F.col("total_amount"))), n)
        kpis[f"{label}_cancellation_rate"] = percent(F.count_if(inside & F.col("is_cancelled")), n)
    one = rows.agg(*[e.alias(n) for n, e in kpis.items()])
    names = ("revenue", "bookings", "avg_booking_value", "cancellation_rate")
    long = one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("kpi"), F.col(f"current_{n}").alias("current_value"), F.col(f"previous_{n}").alias("previous_value")) for n in names
    ])))
    return long.withColumn("pct_change", percent(F.col("current_value") - F.col("previous_value"), "previous_value"))


def revenue_yoy(daily: DataFrame, start: str, end: str, grain: str = "month") -> DataFrame:
    """Each period beside the same period one year earlier (NULL when there is none)."""
    grouped = daily.groupBy(period_start(grain, "check_in_date").alias("period_start")).agg(
        total("total_booking_value").alias("revenue"), count_sum("booking_count").alias("bookings")
    )
    earlier = grouped.select(
        F.add_months("period_start", 12).alias("period_start"), F.col("revenue").alias("revenue_last_year"), F.col("bookings").alias("bookings_last_year")
    )
    return (
        grouped.where(in_range("period_start", start, end)).join(earlier, "period_start", "left")
        .withColumn("revenue_yoy_pct", percent(F.col("revenue") - F.col("revenue_last_year"), "revenue_last_year"))
        .orderBy("period_start")
    )
