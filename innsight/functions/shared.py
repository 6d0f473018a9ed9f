"""Expressions the report functions share.

Reports return money and ratios as DOUBLE. Money is summed as decimal first, so the
sums are exact and independent of the row order, and each ratio is one division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: str | Column) -> Column:
    return F.sum(col_of(c)).cast("double")


def count_sum(c: str | Column) -> Column:
    """Sum of counts as BIGINT, 0 for an empty group."""
    return F.coalesce(F.sum(col_of(c)), F.lit(0)).cast("long")


def mean(c: str | Column) -> Column:
    return F.try_divide(F.sum(col_of(c)).cast("double"), F.count(col_of(c)))


def ratio(num: str | Column, den: str | Column) -> Column:
    """Quotient, NULL for a zero or missing denominator."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def percent(num: str | Column, den: str | Column) -> Column:
    return ratio(num, den) * 100


def in_range(column: str, start: str, end: str) -> Column:
    """Closed date range given as text, pushed down to the scan."""
    return F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def days_between(start: str, end: str) -> Column:
    return F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date"))


def current(dim: DataFrame) -> DataFrame:
    return dim.where("is_current")


def place(df: DataFrame | None = None) -> Column:
    """'city, state, country' label; NULL when any part is unknown."""
    sep = F.lit(", ")
    return F.concat("destination", sep, "state_or_province", sep, "country")


def destination_labels(dim_destination: DataFrame) -> DataFrame:
    return dim_destination.select("destination_id", place().alias("destination"))


def period_start(grain: str, column: str) -> Column:
    return F.date_trunc(grain, F.col(column)).cast("date")


def period_name(grain: str, start: str) -> Column:
    day = F.col(start)
    names = {
        "week": F.concat(F.lit("Week "), F.weekofyear(day), F.lit(" "), F.year(day)),
        "month": F.date_format(day, "MMMM yyyy"),
        "quarter": F.concat(F.lit("Q"), F.quarter(day), F.lit(" "), F.year(day)),
        "year": F.year(day).cast("string"),
    }
    return names.get(grain, F.date_format(day, "yyyy-MM-dd"))


def bucket(value: Column, cuts: list[tuple[float, str]], last: str) -> Column:
    """Half-open buckets: the first cut above the value names it."""
    chain = None
    for upper, name in cuts:
        chain = F.when(value < upper, name) if chain is None else chain.when(value < upper, name)
    return chain.when(value.isNotNull(), last)


def label_order(column: str, labels: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(column))


# --- bookings and engagement reduced to a key before any dimension joins ---------------

def bookings_by(detail: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Booking totals per key in a check-in range; one shuffle on the key."""
    return (
        detail.where(in_range("check_in_date", start, end))
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("bookings"),
            F.sum("total_amount").alias("revenue"),
            F.count_if("is_cancelled").alias("cancelled"),
            F.sum("nights_booked").alias("nights"),
        )
    )


def daily_by_property(daily: DataFrame, start: str, end: str) -> DataFrame:
    return daily.where(in_range("check_in_date", start, end)).groupBy("property_id").agg(
        F.sum("booking_count").alias("bookings")
    )


def engagement_by_property(engagement: DataFrame, start: str, end: str) -> DataFrame:
    """Engagement totals per property, kept as sums and counts so that they add up further."""
    spent = F.coalesce("avg_time_on_page", F.lit(0).cast("decimal(10,2)"))
    return (
        engagement.where(in_range("engagement_date", start, end))
        .groupBy("property_id")
        .agg(
            F.sum("view_count").alias("views"),
            F.sum("unique_user_views").alias("viewers"),
            F.sum("click_count").alias("clicks"),
            F.sum("search_count").alias("searches"),
            F.sum("conversion_rate").alias("conversion_sum"),
            F.count("conversion_rate").alias("conversion_days"),
            F.sum(spent).alias("time_sum"),
            F.count(F.lit(1)).alias("days"),
        )
    )


def bookings_on_engaged_days(engagement: DataFrame, daily: DataFrame, start: str, end: str) -> DataFrame:
    """Bookings per property whose check-in day also has engagement."""
    active = engagement.where(in_range("engagement_date", start, end)).select(
        "property_id", F.col("engagement_date").alias("check_in_date")
    )
    return (
        daily.where(in_range("check_in_date", start, end))
        .select("property_id", "check_in_date", "booking_count")
        .join(active, ["property_id", "check_in_date"], "left_semi")
        .groupBy("property_id")
        .agg(F.sum("booking_count").alias("booked"))
    )
