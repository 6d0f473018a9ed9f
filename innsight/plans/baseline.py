"""Closed-form predictions with the layout of the scored prediction tables.

Historic means stand in for a model: the same columns, repeatable values. They serve
as the fallback when no model has been trained and let the summaries be checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.functions.shared import current, mean, ratio
from innsight.plans.features import encode, is_peak

LTV_MULTIPLE = 1.5  # fixed value: a year is worth one and a half times the spend up to now


def ltv_segment(value: Column) -> Column:
    # Value bands of the prediction table.
    return F.when(value >= 2500, "VIP").when(value >= 1000, "High").when(value >= 500, "Medium").otherwise("Low")


def stamped(df: DataFrame, model: str, scoring_date: str) -> DataFrame:
    return df.withColumns({"model_name": F.lit(model), "scoring_date": F.lit(scoring_date).cast("date")})


def _coded(dim_property: DataFrame, codes: DataFrame) -> DataFrame:
    return encode(current(dim_property).select("property_id", "destination_id", "property_type"), "property_type", codes)


def demand(dim_property: DataFrame, daily: DataFrame, codes: DataFrame, scoring_date: str) -> DataFrame:
    seen = daily.groupBy("property_id").agg(mean("booking_count").alias("predicted_bookings"))
    return stamped(_coded(dim_property, codes).join(seen, "property_id"), "demand_predictor", scoring_date)


def conversion(dim_property: DataFrame, labels: DataFrame, codes: DataFrame, scoring_date: str) -> DataFrame:
    seen = labels.groupBy("property_id").agg(mean("is_converted").alias("conversion_probability"))
    rows = _coded(dim_property, codes).join(seen, "property_id").withColumn(
        "predicted_conversion", (F.col("conversion_probability") > 0.5).cast("int")
    )
    return stamped(rows, "conversion_predictor", scoring_date)


def pricing(daily: DataFrame, scoring_date: str) -> DataFrame:
    """Revenue per booked night by property and month."""
    day = F.col("check_in_date")
    nights = F.col("booking_count") * F.col("avg_nights_booked")
    rows = daily.where("avg_nights_booked > 0").groupBy(
        "property_id", F.month(day).alias("month"), F.quarter(day).alias("quarter"), is_peak(day).cast("int").alias("is_peak_season")
    ).agg(ratio(F.sum("total_booking_value"), F.sum(nights)).alias("recommended_price"))
    return stamped(rows, "pricing_optimizer", scoring_date)


def lifetime_value(users: DataFrame, scoring_date: str) -> DataFrame:
    rows = users.withColumn("predicted_ltv_12m", F.col("total_spend") * LTV_MULTIPLE)
    return stamped(rows.withColumn("ltv_segment", ltv_segment(F.col("predicted_ltv_12m"))), "customer_ltv_predictor", scoring_date)


def dated_demand(dim_property: DataFrame, daily: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Expected bookings per property and day of the next ``days``: its mean per calendar month-day share."""
    last = F.lit(as_of).cast("date")
    span = daily.agg(F.datediff(F.max("check_in_date"), F.min("check_in_date")) + 1).scalar()
    rate = daily.groupBy("property_id").agg(F.sum("booking_count").alias("n")).withColumn("predicted_bookings", F.col("n") / span)
    ahead = F.explode(F.sequence(F.date_add(last, 1), F.date_add(last, days))).alias("check_in_date")
    return current(dim_property).select("property_id", "destination_id").join(rate, "property_id").select(
        "property_id", "destination_id", ahead, "predicted_bookings"
    )
