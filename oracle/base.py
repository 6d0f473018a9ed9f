"""Shared DuckDB views of the check: sources, cleaned tables, dimensions and facts.

``with_views(sql)`` prepends exactly the common table expressions ``sql`` needs.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-02'"

VIEWS: dict[str, str] = {
    # --- sources -----------------------------------------------------------------
    "src_destinations": """SELECT CAST(n_nationkey AS BIGINT) AS destination_id, n_name AS destination, r_name AS country,
        'State ' || (n_nationkey % 7) AS state_or_province, 'S' || (n_nationkey % 7) AS state_or_province_code,
        n_name || ' in ' || r_name AS description FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "src_countries": """SELECT n_name AS country,
        upper(substr(r_name, 1, CASE WHEN n_nationkey % 6 = 0 THEN 3 ELSE 2 END)) AS country_code, r_name AS continent
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "src_users": """SELECT c_custkey AS user_id,
        'user' || c_custkey || CASE WHEN c_custkey % 97 = 0 THEN '' ELSE '@example.com' END AS email,
        c_name AS name, n_name AS country, c_mktsegment IN ('BUILDING','MACHINERY') AS is_business,
        CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'business' ELSE 'individual' END AS user_type,
        CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN c_name || ' Ltd' END AS company_name,
        DATE '1994-01-01' + CAST(c_custkey % 360 AS INTEGER) AS created_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "src_hosts": """SELECT s_suppkey AS host_id, s_name AS name, 'host' || s_suppkey || '@example.com' AS email,
        '+' || s_suppkey AS phone, s_suppkey % 3 <> 0 AS is_verified, s_suppkey % 7 <> 0 AS is_active,
        CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE 1.0e0 + (s_suppkey % 9) * 0.5e0 END AS rating,
        n_name AS country, DATE '1993-01-01' + CAST(s_suppkey % 700 AS INTEGER) AS joined_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "src_properties": """SELECT p_partkey AS property_id, s_suppkey AS host_id, CAST(s_nationkey AS BIGINT) AS destination_id,
        p_name AS title, 'A ' || p_name AS description,
        CAST(CAST(p_retailprice AS DECIMAL(18,2)) + (p_partkey % 8) * 50
             - CASE WHEN p_partkey % 101 = 0 THEN 2000 ELSE 850 END AS DECIMAL(18,2)) AS base_price,
        p_type AS property_type, p_size % 8 + 1 AS max_guests, p_size % 5 + 1 AS bedrooms, p_size % 3 + 1 AS bathrooms,
        CAST(p_partkey % 185 - 92 AS DOUBLE) AS property_latitude,
        CAST(p_partkey % 361 - 180 AS DOUBLE) AS property_longitude,
        DATE '1994-06-01' + CAST(p_partkey % 200 AS INTEGER) AS created_at
        FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT max(s_suppkey) + 1 FROM supplier)""",
    "src_amenities": """SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS amenity_id, p_brand AS name,
        'cat' || (CAST(substr(p_brand, 7) AS BIGINT) % 3) AS category, '*' AS icon FROM part""",
    "src_property_amenities": "SELECT p_partkey AS property_id, CAST(substr(p_brand, 7) AS BIGINT) AS amenity_id FROM part",
    "src_property_images": """SELECT l_orderkey * 10 + l_linenumber AS image_id, l_partkey AS property_id,
        'https://img.example.com/' || l_orderkey || '/' || l_linenumber AS url, l_linenumber AS sequence,
        l_linenumber = 1 AS is_primary, CAST(l_shipdate AS DATE) AS uploaded_at FROM lineitem""",
    "src_employees": """SELECT c_custkey AS employee_id, c_custkey % (SELECT max(s_suppkey) + 1 FROM supplier) AS host_id,
        c_name AS name, lower(c_mktsegment) AS role, 'staff' || c_custkey || '@example.com' AS email,
        '+' || c_custkey AS phone, n_name AS country,
        DATE '1989-06-01' + CAST(c_custkey % 900 AS INTEGER) AS joined_at,
        CASE WHEN c_custkey % 5 = 0 THEN DATE '1989-06-01' + CAST(c_custkey % 900 + c_custkey % 40 - 10 AS INTEGER) END
            AS end_service_date,
        c_custkey % 5 <> 0 AS is_currently_employed FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "src_bookings": """SELECT o_orderkey AS booking_id, o_custkey AS user_id, property_id, CAST(o_orderdate AS DATE) AS check_in,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 12 AS INTEGER) AS check_out,
        CAST(o_orderkey % 6 AS INTEGER) AS guests_count,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS total_amount,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'confirmed' ELSE 'cancelled' END AS status,
        CAST(o_orderdate AS DATE) - CAST(o_orderkey % 60 AS INTEGER) AS created_at,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 - o_orderkey % 60 AS INTEGER) AS updated_at
        FROM orders JOIN (SELECT l_orderkey, min(l_partkey) AS property_id FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "src_booking_updates": """SELECT l_orderkey * 10 + l_linenumber AS booking_update_id, l_orderkey AS booking_id,
        l_partkey AS property_id, l_orderkey % 1000 AS user_id,
        CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER) AS check_in,
        CAST(l_shipdate AS DATE) + CAST(l_linenumber + l_suppkey % 9 AS INTEGER) AS check_out,
        CASE l_returnflag WHEN 'R' THEN 'cancelled' WHEN 'A' THEN 'confirmed' ELSE 'completed' END AS status,
        CAST(l_shipdate AS DATE) + CAST(3 - l_partkey % 8 AS INTEGER) AS created_at,
        CAST(l_shipdate AS DATE) AS updated_at FROM lineitem""",
    "src_payments": """SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS booking_id,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(18,4)) AS amount,
        CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'paypal' END AS payment_method,
        CASE l_linestatus WHEN 'F' THEN 'completed' ELSE 'refunded' END AS status,
        CAST(l_shipdate AS DATE) AS payment_date FROM lineitem""",
    "src_events": """SELECT event_id, event_type, user_id, event_id % (SELECT max(p_partkey) + 1 FROM part) AS property_id,
        CAST(ts AS TIMESTAMP) - INTERVAL 8766 DAYS AS timestamp,
        CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
        CASE event_id % 4 WHEN 0 THEN 'google' WHEN 1 THEN 'direct' WHEN 2 THEN 'ad' ELSE 'email' END AS referrer
        FROM events""",
    "src_clickstream": """SELECT CASE event_type WHEN 'signup' THEN 'search' WHEN 'purchase' THEN 'filter'
        WHEN 'error' THEN '' ELSE event_type END AS event, device, referrer, property_id, timestamp, user_id FROM src_events""",
    "src_page_views": """SELECT event_id AS view_id, user_id, property_id, timestamp, '/listing/' || property_id AS page_url,
        device AS device_type, referrer FROM src_events WHERE event_type IN ('view','click')""",
    "src_reviews": """SELECT o_orderkey AS review_id, o_orderkey AS booking_id, coalesce(property_id, 0) AS property_id,
        o_custkey AS user_id, 0.5e0 + (o_orderkey % 10) * 0.5e0 AS rating,
        CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS comment,
        CAST(o_orderdate AS DATE) + 20 AS created_at,
        CAST(o_orderdate AS DATE) + CAST(20 + o_orderkey % 2 AS INTEGER) AS updated_at, o_orderkey % 50 = 0 AS is_deleted
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS property_id FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
        WHERE o_orderkey % 4 = 0""",
    "src_support": """SELECT conv_id || '-' || turn AS ticket_id, conv_id AS user_id, 'agent' || (conv_id % 5) AS support_agent_id,
        '2000-01-05' AS created_at, len(string_split(text, chr(10))) AS message_count,
        CAST(role = 'assistant' OR len(string_split(text, chr(10))) > 1 AS INTEGER) AS agent_messages,
        len(list_filter(string_split(text, chr(10)), lambda x: length(x) % 5 = 0)) AS negative_messages FROM conversations""",
    "src_locations": """SELECT 'L' || n_nationkey AS "locationKey", n_name AS "localizedName", upper(n_name) AS "englishName",
        substr(r_name, 1, 2) AS country_code, r_name AS country_name, 'A' || (n_nationkey % 7) AS "administrativeArea_id",
        'Area ' || (n_nationkey % 7) AS "administrativeArea_name", 'T' || (n_nationkey % 4) AS timezone_code,
        'Zone ' || (n_nationkey % 4) AS timezone_name, CAST(n_nationkey % 4 AS DOUBLE) AS gmt_offset,
        CAST(n_nationkey * 3 AS DOUBLE) AS latitude, CAST(n_nationkey * 5 AS DOUBLE) AS longitude,
        CAST(n_nationkey * 10 AS DOUBLE) AS elevation_metric_value FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "src_forecasts": """SELECT *, CAST(t % 20 AS DOUBLE) AS "temperatureMin", CAST(t % 20 + "epochDate" % 15 AS DOUBLE) AS "temperatureMax",
        CAST(t % 20 - 2 AS DOUBLE) AS "realFeelMin", CAST(t % 20 + "epochDate" % 15 + 1 AS DOUBLE) AS "realFeelMax",
        CAST("epochDate" % 12 AS DOUBLE) AS "hoursOfSun", CAST(t % 101 AS BIGINT) AS "precipitationProbability",
        CAST("epochDate" % 41 AS BIGINT) AS "thunderstormProbability", CAST(t % 81 AS BIGINT) AS "rainProbability",
        CAST("epochDate" % 11 AS BIGINT) AS "snowProbability", CAST("epochDate" % 7 AS BIGINT) AS "iceProbability",
        CASE WHEN t % 101 > 50 THEN 'Rain' ELSE 'Sunny' END AS "day_iconPhrase", t % 101 > 50 AS "day_hasPrecipitation",
        CASE WHEN t % 81 > 40 THEN 'Showers' ELSE 'Clear' END AS "night_iconPhrase", t % 81 > 40 AS "night_hasPrecipitation",
        CAST("epochDate" % 15 AS DOUBLE) AS temperature_range, t % 101 > 50 AS is_precipitation_expected
        FROM (SELECT 'L' || (event_id % 25) AS "locationKey", CAST(ts AS DATE) - 8766 AS date, event_id AS "epochDate",
              CAST(trunc(CAST(value AS DECIMAL(10,2)) * 10) AS INTEGER) AS t FROM events)""",
    # --- cleaned tables (critical rules hold) --------------------------------------
    "s_users": "SELECT * FROM src_users WHERE instr(email, '@') > 0 AND length(name) > 0 AND created_at >= DATE '1990-01-01'",
    "s_hosts": "SELECT * FROM src_hosts WHERE host_id IS NOT NULL AND instr(email, '@') > 0",
    "s_properties": "SELECT * FROM src_properties WHERE base_price > 0 AND max_guests >= 1",
    "s_bookings": """SELECT * FROM src_bookings WHERE check_in >= DATE '1990-01-01' AND check_out > check_in
        AND guests_count >= 1 AND total_amount > 0""",
    "s_booking_updates": "SELECT * FROM src_booking_updates WHERE check_out > check_in",
    "s_payments": """SELECT * FROM src_payments WHERE amount > 0 AND payment_method IS NOT NULL
        AND payment_date >= DATE '1990-01-01'""",
    "s_clickstream": "SELECT * FROM src_clickstream WHERE length(event) > 0 AND timestamp >= DATE '1990-01-01'",
    "s_page_views": "SELECT * FROM src_page_views WHERE length(page_url) > 0 AND timestamp >= DATE '1990-01-01'",
    "s_reviews": "SELECT * FROM src_reviews WHERE rating >= 1.0 AND rating <= 5.0",
    "s_employees": "SELECT * FROM src_employees WHERE joined_at >= DATE '1990-01-01'",
    # --- dimensions ------------------------------------------------------------------
    "dim_user": "SELECT *, TRUE AS is_current FROM s_users",
    "dim_host": "SELECT *, TRUE AS is_current FROM s_hosts",
    "dim_property": "SELECT *, TRUE AS is_current FROM s_properties",
    "dim_destination": "SELECT * FROM src_destinations",
    "dim_date": """SELECT date, year(date) AS year, quarter(date) AS quarter, month(date) AS month, monthname(date) AS month_name,
        weekofyear(date) AS week_of_year, dayofweek(date) + 1 AS day_of_week, dayname(date) AS day_of_week_name,
        day(date) AS day_of_month, dayofyear(date) AS day_of_year, dayofweek(date) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2005-12-31', INTERVAL 1 DAY)) AS DATE) AS date)""",
    # --- facts --------------------------------------------------------------------------
    "last_pay": """SELECT booking_id, amount AS payment_amount, payment_method FROM (SELECT *, row_number() OVER (
        PARTITION BY booking_id ORDER BY payment_date DESC, payment_id DESC, amount DESC, payment_method DESC) AS rn
        FROM s_payments WHERE status = 'completed') WHERE rn = 1""",
    "fact_booking_detail": """SELECT b.booking_id, b.user_id, p.host_id, b.property_id, p.destination_id,
        b.check_in AS check_in_date, b.check_out AS check_out_date, b.guests_count,
        date_diff('day', b.check_in, b.check_out) AS nights_booked, CAST(b.total_amount AS DECIMAL(18,2)) AS total_amount,
        CAST(y.payment_amount AS DECIMAL(18,2)) AS payment_amount, y.payment_method, b.status, b.created_at, b.updated_at,
        date_diff('day', b.created_at, b.check_in) AS days_between_booking_and_checkin,
        b.status = 'cancelled' AS is_cancelled, coalesce(u.is_business, FALSE) AS is_business_booking
        FROM s_bookings b LEFT JOIN last_pay y USING (booking_id) LEFT JOIN s_users u USING (user_id)
        LEFT JOIN s_properties p ON p.property_id = b.property_id""",
    # Averages to cents are rounded half up in whole numbers, as decimal arithmetic does.
    "fact_booking_daily": """SELECT property_id, check_in_date, destination_id, n AS booking_count,
        confirmed AS confirmed_booking_count, cancelled AS cancellation_count,
        CAST(total4 AS DECIMAL(18,2)) AS total_booking_value,
        CAST((2 * CAST(total4 * 10000 AS BIGINT) + 100 * n) // (200 * n) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS avg_booking_value,
        guests AS total_guests,
        CAST((200 * nights + n) // (2 * n) AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS avg_nights_booked,
        CAST((20000 * paid + n) // (2 * n) AS DECIMAL(10,0)) * CAST(0.01 AS DECIMAL(3,2)) AS payment_completion_rate
        FROM (SELECT b.property_id, b.check_in AS check_in_date, max(p.destination_id) AS destination_id, count(*) AS n,
            count(*) FILTER (b.status = 'confirmed') AS confirmed, count(*) FILTER (b.status = 'cancelled') AS cancelled,
            sum(b.total_amount) AS total4, CAST(sum(b.guests_count) AS BIGINT) AS guests,
            CAST(sum(date_diff('day', b.check_in, b.check_out)) AS BIGINT) AS nights, count(y.payment_amount) AS paid
            FROM s_bookings b LEFT JOIN s_properties p ON p.property_id = b.property_id LEFT JOIN last_pay y USING (booking_id)
            GROUP BY 1, 2)""",
    "fact_property_engagement": """SELECT e.*,
        CASE WHEN view_count > 0 THEN CAST((20000 * coalesce(d.booking_count, 0) + view_count) // (2 * view_count)
            AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) END AS conversion_rate,
        CAST(NULL AS DECIMAL(10,2)) AS avg_time_on_page
        FROM (SELECT coalesce(v.property_id, c.property_id) AS property_id,
            coalesce(v.engagement_date, c.engagement_date) AS engagement_date,
            coalesce(view_count, 0) AS view_count, coalesce(unique_user_views, 0) AS unique_user_views,
            coalesce(click_count, 0) AS click_count, coalesce(search_count, 0) AS search_count
            FROM (SELECT property_id, CAST(timestamp AS DATE) AS engagement_date, count(view_id) AS view_count,
                count(DISTINCT user_id) AS unique_user_views FROM s_page_views GROUP BY 1, 2) v
            FULL JOIN (SELECT property_id, CAST(timestamp AS DATE) AS engagement_date,
                count(*) FILTER (event = 'click') AS click_count, count(*) FILTER (event = 'search') AS search_count
                FROM s_clickstream GROUP BY 1, 2) c
            ON v.property_id = c.property_id AND v.engagement_date = c.engagement_date) e
        LEFT JOIN fact_booking_daily d ON d.property_id = e.property_id AND d.check_in_date = e.engagement_date""",
    "fact_weather_daily": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY "locationKey", date ORDER BY "epochDate" DESC) AS rn FROM src_forecasts) WHERE rn = 1""",
}

# Observed days: a year before the forecasts, three tenths warmer.
VIEWS["src_history"] = VIEWS["src_forecasts"].replace("- 8766", "- 9131").replace("* 10) AS INTEGER)", "* 10) AS INTEGER) + 3")

_WORDS = {name: re.compile(rf"\b{name}\b") for name in VIEWS}


def add_view(name: str, sql: str) -> None:
    VIEWS[name] = sql
    _WORDS[name] = re.compile(rf"\b{name}\b")


def _needs(sql: str, skip: str = "") -> list[str]:
    return [n for n, pattern in _WORDS.items() if n != skip and pattern.search(sql)]


def with_views(sql: str) -> str:
    """``sql`` as one statement with the views it (transitively) reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _needs(VIEWS[name], name):
            visit(dep)
        order.append(name)

    for name in _needs(sql):
        visit(name)
    if not order:
        return sql
    # Each view is computed once, however often others read it.
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in order) + "\n" + sql


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def mean(expr: str) -> str:
    """Exact sum divided once, as the library does."""
    return f"CAST(SUM({expr}) AS DOUBLE) / NULLIF(COUNT({expr}), 0)"


def ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF({den}, 0)"
