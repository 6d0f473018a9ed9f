"""Summaries of prediction tables.

A prediction table has its keys, the predicted column, ``model_name`` and
``scoring_date``. Averages of model output are rounded to six digits so that they do
not depend on summation order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.functions.shared import current, mean
from innsight.operators.ordered import top_ranked

def _avg(column: str) -> Column:
    return F.round(F.avg(F.col(column).cast("double")), 6)


def _stamp() -> list[Column]:
    return [F.max("scoring_date").alias("scoring_date"), F.max("model_name").alias("model_name")]


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def get_demand_predictions(predictions: DataFrame, destination_id: int | None = None, min_predicted_bookings: float = 0) -> DataFrame:
    rows = predictions.where(F.col("predicted_bookings") >= min_predicted_bookings)
    if destination_id is not None:
        rows = rows.where(F.col("destination_id") == destination_id)
    return (
        rows.groupBy("destination_id", "property_type")
        .agg(_avg("predicted_bookings").alias("avg_predicted_bookings"), F.max("predicted_bookings").alias("max_predicted_bookings"), _n("prediction_count"), *_stamp())
        .orderBy(F.desc("avg_predicted_bookings"), "destination_id", "property_type")
    )


def get_conversion_predictions(predictions: DataFrame, min_probability: float = 0, destination_id: int | None = None) -> DataFrame:
    rows = predictions.where(F.col("conversion_probability") >= min_probability)
    if destination_id is not None:
        rows = rows.where(F.col("destination_id") == destination_id)
    return (
        rows.groupBy("destination_id", "property_type")
        .agg(
            _avg("conversion_probability").alias("avg_conversion_probability"), F.max("conversion_probability").alias("max_conversion_probability"),
            _avg("predicted_conversion").alias("predicted_conversion_rate"), _n("prediction_count"), *_stamp(),
        )
        .orderBy(F.desc("avg_conversion_probability"), "destination_id", "property_type")
    )


def get_pricing_recommendations(predictions: DataFrame, month: int | None = None, is_peak_season: int | None = None) -> DataFrame:
    rows = predictions
    if month is not None:
        rows = rows.where(F.col("month") == month)
    if is_peak_season is not None:
        rows = rows.where(F.col("is_peak_season") == is_peak_season)
    price = F.col("recommended_price").cast("double")
    return (
        rows.groupBy("month", "quarter", "is_peak_season")
        .agg(_avg("recommended_price").alias("avg_recommended_price"), F.min(price).alias("min_recommended_price"), F.max(price).alias("max_recommended_price"),
             _n("prediction_count"), *_stamp())
        .orderBy(F.desc("avg_recommended_price"), "month")
    )


def get_pricing_by_destination(
    dim_property: DataFrame, dim_destination: DataFrame, predictions: DataFrame, destination: str, as_of: str | None = None
) -> DataFrame:
    """Base prices of matching destinations times the month's seasonal factor (a scalar, 1 when unknown)."""
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    season = predictions.where(F.col("month") == F.month(today)).agg(F.round(F.avg(F.col("recommended_price").cast("double")), 6) / 100).scalar()
    places = dim_destination.where(F.contains(F.lower("destination"), F.lit(destination.lower()))).select("destination_id", "destination")
    listed = current(dim_property).join(places, "destination_id").groupBy("destination", "property_type").agg(
        _n("property_count"), mean("base_price").alias("avg_base_price"), F.min("base_price").cast("double").alias("min_base_price"),
        F.max("base_price").cast("double").alias("max_base_price"),
    )
    factor = F.coalesce(season, F.lit(1.0))
    price = lambda c: F.round(F.col(c) * F.col("ml_seasonal_adjustment")).cast("long").cast("string")
    return listed.withColumn("ml_seasonal_adjustment", factor).withColumn(
        "recommended_price_range", F.concat(F.lit("$"), price("min_base_price"), F.lit(" - $"), price("max_base_price"))
    ).orderBy(F.desc("avg_base_price"), "destination", "property_type")


def get_customer_ltv_predictions(predictions: DataFrame, ltv_segment: str | None = None, min_ltv: float = 0) -> DataFrame:
    rows = predictions.where(F.col("predicted_ltv_12m") >= min_ltv)
    if ltv_segment is not None:
        rows = rows.where(F.col("ltv_segment") == ltv_segment)
    value = F.col("predicted_ltv_12m")
    return (
        rows.groupBy("ltv_segment")
        .agg(_avg("predicted_ltv_12m").alias("avg_predicted_ltv_12m"), F.min(value).alias("min_predicted_ltv_12m"), F.max(value).alias("max_predicted_ltv_12m"),
             _n("customer_count"), *_stamp())
        .orderBy(F.desc("avg_predicted_ltv_12m"))
    )


def get_vip_customers(predictions: DataFrame) -> DataFrame:
    value = F.col("predicted_ltv_12m")
    return predictions.where("ltv_segment = 'VIP'").groupBy("ltv_segment").agg(
        _n("vip_customer_count"), _avg("predicted_ltv_12m").alias("avg_predicted_ltv_12m"), F.min(value).alias("min_predicted_ltv_12m"),
        F.max(value).alias("max_predicted_ltv_12m"), F.max("scoring_date").alias("scoring_date"),
    )


def get_high_demand_properties(predictions: DataFrame, top_n: int = 100) -> DataFrame:
    grouped = predictions.groupBy("destination_id", "property_type").agg(
        _avg("predicted_bookings").alias("avg_predicted_bookings"), F.max("predicted_bookings").alias("max_predicted_bookings"), _n("property_count"),
        F.max("scoring_date").alias("scoring_date"),
    )
    return top_ranked(grouped, top_n, [F.desc("avg_predicted_bookings"), F.asc("destination_id"), F.asc("property_type")]).orderBy("rank")


# Segments by priority, their conditions (SQL) and descriptions; the last one takes the rest.
SEGMENT_RULES = (
    ("High-Value Customers", "predicted_ltv_12m > 2500 AND total_bookings >= 5", "VIP treatment, loyalty programs - LTV > $2500 and 5+ bookings"),
    ("At-Risk Customers", "days_since_last_booking > 90 OR cancellation_rate > 0.3", "Win-back campaigns - 90+ days inactive or high cancellation"),
    ("Repeat Travelers", "total_bookings >= 3 AND CAST(is_repeat AS BOOLEAN)", "Loyalty rewards - 3+ bookings with repeat behavior"),
    ("Price-Sensitive", "avg_booking_value < 200", "Discount campaigns - avg booking < $200"),
    ("New Prospects", "total_bookings < 2 AND tenure_days < 30", "Onboarding incentives - <2 bookings, <30 days tenure"),
    ("Standard Customers", "TRUE", "Standard customer base"),
)
SEGMENT_TEXT = {name: text for name, _, text in SEGMENT_RULES}


def segment_label() -> Column:
    return F.coalesce(*[F.when(F.expr(given), F.lit(name)) for name, given, _ in SEGMENT_RULES])


def get_customer_segment_distribution(predictions: DataFrame) -> DataFrame:
    text = F.create_map(*[F.lit(x) for pair in SEGMENT_TEXT.items() for x in pair])
    avg2 = lambda c: F.round(F.round(F.avg(F.col(c).cast("double")), 6), 2)
    grouped = predictions.groupBy(segment_label().alias("segment_name")).agg(
        _n("customer_count"), avg2("predicted_ltv_12m").alias("avg_ltv"), avg2("total_bookings").alias("avg_total_bookings"), avg2("total_spend").alias("avg_total_spend"),
        F.max("scoring_date").alias("scoring_date"),
    )
    everyone = F.sum("customer_count").over(Window.partitionBy())
    return grouped.select(
        "segment_name", text[F.col("segment_name")].alias("segment_description"), "customer_count",
        F.round(F.col("customer_count") * 100.0 / everyone, 2).cast("double").alias("pct_of_total"), "avg_ltv", "avg_total_bookings", "avg_total_spend", "scoring_date",
    ).orderBy(F.desc("customer_count"), "segment_name")


# What each model predicts.
MODEL_TEXT = {
    "demand_predictor": "Predicts booking demand by property",
    "conversion_predictor": "Predicts booking conversion probability",
    "pricing_optimizer": "Recommends optimal property prices",
    "customer_ltv_predictor": "Predicts customer 12-month lifetime value",
}


def get_ml_predictions_summary(predictions: dict[str, DataFrame]) -> DataFrame:
    parts = [
        frame.agg(_n("prediction_count"), F.max("scoring_date").alias("latest_scoring_date")).select(
            F.lit(name).alias("model_name"), "prediction_count", "latest_scoring_date", F.lit(MODEL_TEXT[name]).alias("description")
        )
        for name, frame in predictions.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def get_high_conversion_properties(predictions: DataFrame, top_n: int = 100) -> DataFrame:
    rows = predictions.select("property_id", "destination_id", "property_type", "conversion_probability", "scoring_date")
    return top_ranked(rows, top_n, [F.desc("conversion_probability"), F.asc("property_id")]).orderBy("rank")


def get_at_risk_customers(predictions: DataFrame) -> DataFrame:
    return predictions.where(segment_label() == "At-Risk Customers").select(
        "user_id", "predicted_ltv_12m", "total_bookings", "total_spend", "days_since_last_booking", "cancellation_rate"
    )


def forecast_regional(predictions: DataFrame, dim_destination: DataFrame) -> DataFrame:
    """Predicted bookings per destination and day of a dated demand forecast."""
    per_day = predictions.groupBy("destination_id", "check_in_date").agg(F.round(F.sum("predicted_bookings"), 6).alias("predicted_bookings"), _n("properties"))
    return per_day.join(dim_destination.select("destination_id", "destination", "country"), "destination_id")


def forecast_seasonality(predictions: DataFrame, dim_destination: DataFrame) -> DataFrame:
    """Mean predicted demand per month and destination."""
    per_month = predictions.groupBy("destination_id", F.month("check_in_date").alias("month")).agg(
        _avg("predicted_bookings").alias("avg_predicted_bookings"), _n("prediction_count")
    )
    return per_month.join(dim_destination.select("destination_id", "destination"), "destination_id")
