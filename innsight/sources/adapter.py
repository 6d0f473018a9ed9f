"""Marketplace source tables derived from the generic star-schema test tables.

Each function takes a ``raw(name)`` reader and returns the DataFrame a marketplace
source system would deliver. Money is cast to decimal before any arithmetic.
Click and view events are moved back by ``EVENT_SHIFT_DAYS`` so that they overlap
the booking dates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Raw = Callable[[str], DataFrame]

EVENT_SHIFT_DAYS = 8766


def destinations(raw: Raw) -> DataFrame:
    nation, region = raw("nation"), raw("region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS destination_id",
        "n_name AS destination",
        "r_name AS country",
        "concat('State ', n_nationkey % 7) AS state_or_province",
        "concat('S', n_nationkey % 7) AS state_or_province_code",
        "concat(n_name, ' in ', r_name) AS description",
    )


def countries(raw: Raw) -> DataFrame:
    nation, region = raw("nation"), raw("region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_name AS country",
        "concat(' ', lower(substr(r_name, 1, IF(n_nationkey % 6 = 0, 3, 2))), ' ') AS country_code",
        "r_name AS continent",
    )


def users(raw: Raw) -> DataFrame:
    customer, nation = raw("customer"), raw("nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "c_custkey AS user_id",
        "concat('  USER', c_custkey, IF(c_custkey % 97 = 0, '', '@Example.com'), ' ') AS email",
        "c_name AS name",
        "n_name AS country",
        "IF(c_mktsegment IN ('BUILDING', 'MACHINERY'), 'business', 'individual') AS user_type",
        "c_mktsegment IN ('BUILDING', 'MACHINERY') AS is_business",
        "IF(c_mktsegment IN ('BUILDING', 'MACHINERY'), concat(c_name, ' Ltd'), NULL) AS company_name",
        "date_add(DATE'1994-01-01', CAST(c_custkey % 360 AS INT)) AS created_at",
    )


def hosts(raw: Raw) -> DataFrame:
    supplier, nation = raw("supplier"), raw("nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).selectExpr(
        "s_suppkey AS host_id",
        "s_name AS name",
        "concat(' Host', s_suppkey, '@Example.com ') AS email",
        "concat('+', s_suppkey) AS phone",
        "s_suppkey % 3 <> 0 AS is_verified",
        "s_suppkey % 7 <> 0 AS is_active",
        "IF(s_suppkey % 11 = 0, NULL, 1.0D + (s_suppkey % 9) * 0.5D) AS rating",
        "n_name AS country",
        "date_add(DATE'1993-01-01', CAST(s_suppkey % 700 AS INT)) AS joined_at",
    )


def properties(raw: Raw) -> DataFrame:
    supplier = raw("supplier")
    spread = supplier.agg((F.max("s_suppkey") + 1).alias("n")).scalar()
    part = raw("part").withColumn("owner", F.col("p_partkey") % spread)
    return part.join(supplier, part.owner == supplier.s_suppkey).selectExpr(
        "p_partkey AS property_id",
        "owner AS host_id",
        "CAST(s_nationkey AS BIGINT) AS destination_id",
        "p_name AS title",
        "concat('A ', p_name) AS description",
        "CAST(CAST(p_retailprice AS DECIMAL(18,2)) + (p_partkey % 8) * 50"
        " - IF(p_partkey % 101 = 0, 2000, 850) AS DECIMAL(18,2)) AS base_price",
        "p_type AS property_type",
        "p_size % 8 + 1 AS max_guests",
        "p_size % 5 + 1 AS bedrooms",
        "p_size % 3 + 1 AS bathrooms",
        "CAST(p_partkey % 185 - 92 AS DOUBLE) AS property_latitude",
        "CAST(p_partkey % 361 - 180 AS DOUBLE) AS property_longitude",
        "date_add(DATE'1994-06-01', CAST(p_partkey % 200 AS INT)) AS created_at",
    )


def amenities(raw: Raw) -> DataFrame:
    return (
        raw("part")
        .selectExpr("CAST(substr(p_brand, 7) AS BIGINT) AS amenity_id", "p_brand AS name")
        .distinct()
        .selectExpr("amenity_id", "name", "concat('cat', amenity_id % 3) AS category", "'*' AS icon")
    )


def property_amenities(raw: Raw) -> DataFrame:
    return raw("part").selectExpr(
        "p_partkey AS property_id", "CAST(substr(p_brand, 7) AS BIGINT) AS amenity_id"
    )


def property_images(raw: Raw) -> DataFrame:
    return raw("lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS image_id",
        "l_partkey AS property_id",
        "concat('https://img.example.com/', l_orderkey, '/', l_linenumber) AS url",
        "l_linenumber AS sequence",
        "l_linenumber = 1 AS is_primary",
        "CAST(l_shipdate AS DATE) AS uploaded_at",
    )


def employees(raw: Raw) -> DataFrame:
    customer, nation, supplier = raw("customer"), raw("nation"), raw("supplier")
    spread = supplier.agg((F.max("s_suppkey") + 1).alias("n")).scalar()
    staff = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return staff.withColumn("works_for", F.col("c_custkey") % spread).selectExpr(
        "c_custkey AS employee_id",
        "works_for AS host_id",
        "c_name AS name",
        "lower(c_mktsegment) AS role",
        "concat(' Staff', c_custkey, '@Example.com ') AS email",
        "concat('+', c_custkey) AS phone",
        "n_name AS country",
        "date_add(DATE'1989-06-01', CAST(c_custkey % 900 AS INT)) AS joined_at",
        "IF(c_custkey % 5 = 0, date_add(DATE'1989-06-01', CAST(c_custkey % 900 + c_custkey % 40 - 10 AS INT)), NULL)"
        " AS end_service_date",
        "c_custkey % 5 <> 0 AS is_currently_employed",
    )


def bookings(raw: Raw) -> DataFrame:
    orders = raw("orders")
    listed = raw("lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("property_id"))
    joined = orders.join(listed, orders.o_orderkey == listed.l_orderkey)
    return joined.withColumn("check_in", F.col("o_orderdate").cast("date")).selectExpr(
        "o_orderkey AS booking_id",
        "o_custkey AS user_id",
        "property_id",
        "check_in",
        "date_add(check_in, CAST(o_orderkey % 12 AS INT)) AS check_out",
        "CAST(o_orderkey % 6 AS INT) AS guests_count",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS total_amount",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'confirmed' ELSE 'cancelled' END AS status",
        "date_add(check_in, -CAST(o_orderkey % 60 AS INT)) AS created_at",
        "date_add(check_in, CAST(o_orderkey % 5 - o_orderkey % 60 AS INT)) AS updated_at",
    )


def booking_updates(raw: Raw) -> DataFrame:
    return raw("lineitem").withColumn("day", F.col("l_shipdate").cast("date")).selectExpr(
        "l_orderkey * 10 + l_linenumber AS booking_update_id",
        "l_orderkey AS booking_id",
        "l_partkey AS property_id",
        "l_orderkey % 1000 AS user_id",
        "date_add(day, CAST(l_linenumber AS INT)) AS check_in",
        "date_add(day, CAST(l_linenumber + l_suppkey % 9 AS INT)) AS check_out",
        "CASE l_returnflag WHEN 'R' THEN 'cancelled' WHEN 'A' THEN 'confirmed' ELSE 'completed' END AS status",
        "date_add(day, CAST(3 - l_partkey % 8 AS INT)) AS created_at",
        "day AS updated_at",
    )


def payments(raw: Raw) -> DataFrame:
    return raw("lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS payment_id",
        "l_orderkey AS booking_id",
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(18,4)) AS amount",
        "CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'paypal' END AS payment_method",
        "CASE l_linestatus WHEN 'F' THEN 'completed' ELSE 'refunded' END AS status",
        "CAST(l_shipdate AS DATE) AS payment_date",
    )


def _shifted_events(raw: Raw) -> DataFrame:
    spread = raw("part").agg((F.max("p_partkey") + 1).alias("n")).scalar()
    return raw("events").withColumns(
        {
            "property_id": F.col("event_id") % spread,
            "timestamp": F.expr(f"CAST(ts AS TIMESTAMP_NTZ) - INTERVAL '{EVENT_SHIFT_DAYS}' DAY"),
            "device": F.expr("CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END"),
            "referrer": F.expr(
                "CASE event_id % 4 WHEN 0 THEN 'google' WHEN 1 THEN 'direct' WHEN 2 THEN 'ad' ELSE 'email' END"
            ),
        }
    )


def clickstream(raw: Raw) -> DataFrame:
    return _shifted_events(raw).selectExpr(
        "CASE event_type WHEN 'signup' THEN 'search' WHEN 'purchase' THEN 'filter'"
        " WHEN 'error' THEN '' ELSE event_type END AS event",
        "named_struct('device', device, 'referrer', referrer) AS metadata",
        "property_id",
        "timestamp",
        "user_id",
    )


def page_views(raw: Raw) -> DataFrame:
    return _shifted_events(raw).where("event_type IN ('view', 'click')").selectExpr(
        "event_id AS view_id",
        "user_id",
        "property_id",
        "timestamp",
        "concat('/listing/', property_id) AS page_url",
        "device AS device_type",
        "referrer",
    )


def reviews(raw: Raw) -> DataFrame:
    listed = raw("lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("property_id"))
    rated = raw("orders").where("o_orderkey % 4 = 0")
    return rated.join(listed, rated.o_orderkey == listed.l_orderkey, "left").selectExpr(
        "o_orderkey AS review_id",
        "o_orderkey AS booking_id",
        "coalesce(property_id, 0) AS property_id",
        "o_custkey AS user_id",
        "0.5D + (o_orderkey % 10) * 0.5D AS rating",
        "IF(o_orderkey % 3 = 0, NULL, IF(o_orderkey % 5 = 0, '', o_orderpriority)) AS comment",
        "date_add(CAST(o_orderdate AS DATE), 20) AS created_at",
        "date_add(CAST(o_orderdate AS DATE), CAST(20 + o_orderkey % 2 AS INT)) AS updated_at",
        "o_orderkey % 50 = 0 AS is_deleted",
    )


def support_logs(raw: Raw) -> DataFrame:
    """One ticket per conversation turn; the lines of its text are the messages.

    The array comes from the row itself, so no group of rows is ever collected.
    """
    lines = F.split("text", "\n")
    sender = F.when(F.col("role") == "assistant", "agent").otherwise(F.col("role"))
    return raw("conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("ticket_id"),
        F.col("conv_id").alias("user_id"),
        F.concat(F.lit("agent"), F.col("conv_id") % 5).alias("support_agent_id"),
        F.lit("2000-01-05").alias("created_at"),
        F.transform(
            lines,
            lambda line, i: F.struct(
                line.alias("message"),
                F.when(i % 2 == 1, "agent").otherwise(sender).alias("sender"),
                F.when(F.length(line) % 5 == 0, "negative").otherwise("neutral").alias("sentiment"),
                i.cast("string").alias("timestamp"),
            ),
        ).alias("messages"),
    )


def weather_locations(raw: Raw) -> DataFrame:
    """Nested location records, one per destination."""
    nation, region = raw("nation"), raw("region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "concat('L', n_nationkey) AS locationKey",
        "n_name AS localizedName",
        "upper(n_name) AS englishName",
        "named_struct('id', substr(r_name, 1, 2), 'localizedName', r_name) AS country",
        "named_struct('id', concat('A', n_nationkey % 7), 'localizedName', concat('Area ', n_nationkey % 7))"
        " AS administrativeArea",
        "named_struct('code', concat('T', n_nationkey % 4), 'name', concat('Zone ', n_nationkey % 4),"
        " 'gmtOffset', CAST(n_nationkey % 4 AS DOUBLE)) AS timeZone",
        "named_struct('latitude', CAST(n_nationkey * 3 AS DOUBLE), 'longitude', CAST(n_nationkey * 5 AS DOUBLE),"
        " 'elevation', named_struct('metric', named_struct('value', CAST(n_nationkey * 10 AS DOUBLE))))"
        " AS geoPosition",
    )


def _weather_days(raw: Raw, earlier: int, warmer: int) -> DataFrame:
    events = raw("events").withColumn("tenths", F.expr(f"CAST(CAST(value AS DECIMAL(10,2)) * 10 AS INT) + {warmer}"))
    return events.selectExpr(
        "concat('L', event_id % 25) AS locationKey",
        f"date_add(CAST(ts AS DATE), -{EVENT_SHIFT_DAYS + earlier}) AS date",
        "event_id AS epochDate",
        "named_struct('minimum', named_struct('value', (tenths % 20) * 1.0D, 'unit', 'C'),"
        " 'maximum', named_struct('value', (tenths % 20 + event_id % 15) * 1.0D, 'unit', 'C')) AS temperature",
        "named_struct('minimum', named_struct('value', (tenths % 20 - 2) * 1.0D),"
        " 'maximum', named_struct('value', (tenths % 20 + event_id % 15 + 1) * 1.0D)) AS realFeelTemperature",
        "(event_id % 12) * 1.0D AS hoursOfSun",
        "CAST(tenths % 101 AS INT) AS precipitationProbability",
        "CAST(event_id % 41 AS INT) AS thunderstormProbability",
        "CAST(tenths % 81 AS INT) AS rainProbability",
        "CAST(event_id % 11 AS INT) AS snowProbability",
        "CAST(event_id % 7 AS INT) AS iceProbability",
        "named_struct('iconPhrase', IF(tenths % 101 > 50, 'Rain', 'Sunny'), 'hasPrecipitation', tenths % 101 > 50) AS day",
        "named_struct('iconPhrase', IF(tenths % 81 > 40, 'Showers', 'Clear'), 'hasPrecipitation', tenths % 81 > 40)"
        " AS night",
    )


def weather_forecasts(raw: Raw) -> DataFrame:
    """Nested daily forecasts; several issues of one (location, day) occur."""
    return _weather_days(raw, 0, 0)


def weather_history(raw: Raw) -> DataFrame:
    """Observed days of the year before, in the layout of the forecasts."""
    return _weather_days(raw, 365, 3)


def user_changes(raw: Raw) -> DataFrame:
    """Change log of user attributes: several events per user, some without a change."""
    orders = raw("orders")
    return orders.selectExpr(
        "o_custkey AS user_id",
        "CAST(o_orderdate AS DATE) AS changed_at",
        "o_orderkey AS change_id",
        "IF(o_orderpriority IN ('1-URGENT', '2-HIGH'), 'business', 'individual') AS user_type",
        "IF(o_orderstatus = 'P', 'moved', 'home') AS residence",
    )


def host_changes(raw: Raw) -> DataFrame:
    return raw("lineitem").selectExpr(
        "l_suppkey AS host_id",
        "CAST(l_shipdate AS DATE) AS changed_at",
        "(l_orderkey * 10 + l_linenumber) * 10000 + l_partkey % 10000 AS change_id",
        "l_returnflag = 'R' AS is_verified",
        "l_linestatus = 'O' AS is_active",
    )


def property_changes(raw: Raw) -> DataFrame:
    return raw("lineitem").selectExpr(
        "l_partkey AS property_id",
        "CAST(l_shipdate AS DATE) AS changed_at",
        "(l_orderkey * 10 + l_linenumber) * 10000 + l_suppkey % 10000 AS change_id",
        "CAST(IF(l_discount > 0.05, 100, 80) AS DECIMAL(18,2)) AS base_price",
        "IF(l_linestatus = 'O', 'listed', 'paused') AS listing_state",
    )
