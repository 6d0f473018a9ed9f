"""Cleaned tables: source columns plus derived columns, one function per table.

Every function maps a DataFrame (batch or streaming) to a DataFrame with stateless
column expressions only, so the same code serves both. Flags are two-valued: an
unknown input gives false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shared vocabularies of the source systems.
DIGITAL_METHODS = ("paypal", "apple_pay", "google_pay")
CARD_METHOD = "credit_card"
HANDHELD_DEVICES = ("mobile", "tablet")
ORGANIC_REFERRERS = ("google", "direct")
PAID_REFERRER = "ad"
KEY_SEPARATOR = "||"
LONG_STAY_NIGHTS = 7
HIGH_VALUE_AMOUNT = 1000


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def business_key(*columns: str) -> Column:
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *[F.col(c).cast("string") for c in columns]), 256)


def clean_email(column: str = "email") -> Column:
    return F.lower(F.trim(F.col(column)))


def _stamped(df: DataFrame, processed_at: Column | None, **derived: Column) -> DataFrame:
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return df.withColumns(derived).withColumns({"processed_timestamp": stamp})


def users(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(
        df.withColumn("email", clean_email()), processed_at, user_business_key=business_key("user_id", "email")
    )


def hosts(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(
        df.withColumn("email", clean_email()), processed_at, host_business_key=business_key("host_id", "email")
    )


def destinations(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(df, processed_at, destination_business_key=business_key("destination_id", "destination"))


def countries(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(
        df.withColumn("country_code", F.upper(F.trim("country_code"))),
        processed_at,
        country_business_key=business_key("country", "country_code"),
    )


def properties(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(
        df,
        processed_at,
        has_outdoor_space=flag(F.col("bedrooms") + F.col("bathrooms") > 3),
        property_business_key=business_key("property_id", "host_id"),
    )


def amenities(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(df, processed_at, amenity_business_key=business_key("amenity_id", "name"))


def employees(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(
        df.withColumn("email", clean_email()),
        processed_at,
        is_active=F.col("is_currently_employed"),
        employee_business_key=business_key("employee_id", "host_id"),
    )


def property_amenities(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(df, processed_at, property_amenity_business_key=business_key("property_id", "amenity_id"))


def property_images(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(df, processed_at, property_image_business_key=business_key("image_id", "property_id"))


def bookings(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    nights = F.datediff("check_out", "check_in")
    amount = F.col("total_amount")
    return _stamped(
        df,
        processed_at,
        nights_booked=nights,
        avg_price_per_night=F.when(nights > 0, F.round(amount / nights, 2)).otherwise(amount),
        is_long_stay=flag(nights > LONG_STAY_NIGHTS),
        is_high_value=flag(amount > HIGH_VALUE_AMOUNT),
        booking_business_key=business_key("booking_id"),
    )


def booking_updates(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return _stamped(
        df,
        processed_at,
        nights_booked=F.datediff("check_out", "check_in"),
        days_until_check_in=F.datediff("check_in", "updated_at"),
        is_cancellation=flag(F.col("status") == "cancelled"),
        is_date_change=F.col("check_in").isNotNull() | F.col("check_out").isNotNull(),
        booking_update_business_key=business_key("booking_update_id", "booking_id"),
    )


def payments(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    method, status = F.col("payment_method"), F.col("status")
    return _stamped(
        df,
        processed_at,
        is_completed=flag(status == "completed"),
        is_refund=flag(status == "refunded"),
        is_digital_payment=flag(method.isin(*DIGITAL_METHODS)),
        is_card_payment=flag(method == CARD_METHOD),
        payment_business_key=business_key("payment_id", "booking_id"),
    )


def clickstream(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    event = F.col("event")
    return _stamped(
        df.withColumns({"device": F.col("metadata.device"), "referrer": F.col("metadata.referrer")}),
        processed_at,
        is_mobile_event=flag(F.col("device").isin(*HANDHELD_DEVICES)),
        is_paid_traffic=flag(F.col("referrer") == PAID_REFERRER),
        is_view_event=flag(event == "view"),
        is_click_event=flag(event == "click"),
        is_search_event=flag(event == "search"),
        clickstream_business_key=business_key("user_id", "timestamp", "event"),
    )


def page_views(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    device, referrer = F.col("device_type"), F.col("referrer")
    return _stamped(
        df,
        processed_at,
        is_mobile_view=flag(device.isin(*HANDHELD_DEVICES)),
        is_desktop_view=flag(device == "desktop"),
        is_organic_traffic=flag(referrer.isin(*ORGANIC_REFERRERS)),
        is_paid_traffic=flag(referrer == PAID_REFERRER),
        page_view_business_key=business_key("view_id", "user_id"),
    )


def reviews(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    rating = F.col("rating")
    return _stamped(
        df,
        processed_at,
        is_positive_review=flag(rating >= 4.0),
        is_negative_review=flag(rating <= 2.0),
        is_neutral_review=flag((rating > 2.0) & (rating < 4.0)),
        has_comment=flag(F.col("comment") != ""),
        is_updated=flag(F.col("updated_at") != F.col("created_at")),
        review_business_key=business_key("review_id", "booking_id"),
    )


def support_logs(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    count = F.coalesce(F.size("messages"), F.lit(0))
    return _stamped(
        df,
        processed_at,
        message_count=F.greatest(count, F.lit(0)),
        has_messages=count > 0,
        has_agent_reply=flag(F.exists("messages", lambda m: m["sender"] == "agent")),
        has_negative_sentiment=flag(F.exists("messages", lambda m: m["sentiment"] == "negative")),
        support_ticket_business_key=business_key("ticket_id", "user_id"),
    )


def weather(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Forecast and history records; adds the two convenience columns of the daily fact."""
    return _stamped(
        df,
        processed_at,
        temperature_range=F.col("temperature.maximum.value") - F.col("temperature.minimum.value"),
        is_precipitation_expected=flag(F.col("precipitationProbability") > 50),
    )


BUILDERS = {
    "users": users,
    "hosts": hosts,
    "destinations": destinations,
    "countries": countries,
    "properties": properties,
    "amenities": amenities,
    "employees": employees,
    "property_amenities": property_amenities,
    "property_images": property_images,
    "bookings": bookings,
    "booking_updates": booking_updates,
    "payments": payments,
    "clickstream": clickstream,
    "page_views": page_views,
    "reviews": reviews,
    "support_logs": support_logs,
    "weather_forecasts": weather,
    "weather_history": weather,
}
