"""Sources, cleaned tables and data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from innsight.operators import keys, quality
from innsight.plans import gold, quality_reports
from innsight.plans import rules as rule_table
from innsight.sources import storage
from oracle.base import big, dbl, mean, ratio, with_views

QUERIES: dict = {}
ORACLE: dict = {}


def silver_query(table: str, columns: str, sql_columns: str, view: str, nested: bool = False) -> None:
    QUERIES[f"silver_{table}"] = lambda cat: cat.silver(table).selectExpr(*[c.strip() for c in columns.split(",")])
    ORACLE[f"silver_{table}"] = with_views(f"SELECT {sql_columns} FROM {view}")


def key(*cols: str) -> str:
    return "sha256(" + " || '||' || ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"


silver_query("users", "user_id, email, name, country, user_type, is_business, created_at, user_business_key",
             f"user_id, email, name, country, user_type, is_business, created_at, {key('user_id', 'email')} AS user_business_key", "s_users")
silver_query("hosts", "host_id, email, is_verified, is_active, rating, country, joined_at, host_business_key",
             f"host_id, email, is_verified, is_active, rating, country, joined_at, {key('host_id', 'email')} AS host_business_key", "s_hosts")
silver_query("destinations", "destination_id, destination, country, state_or_province, destination_business_key",
             f"destination_id, destination, country, state_or_province, {key('destination_id', 'destination')} AS destination_business_key", "src_destinations")
silver_query("countries", "country, country_code, continent, country_business_key",
             f"country, country_code, continent, {key('country', 'country_code')} AS country_business_key",
             "src_countries WHERE length(country_code) = 2")
silver_query("properties", "property_id, host_id, destination_id, base_price, bedrooms, bathrooms, has_outdoor_space, property_business_key",
             f"property_id, host_id, destination_id, {dbl('base_price')} AS base_price, {big('bedrooms')} AS bedrooms, {big('bathrooms')} AS bathrooms,"
             f" bedrooms + bathrooms > 3 AS has_outdoor_space, {key('property_id', 'host_id')} AS property_business_key", "s_properties")
silver_query("amenities", "amenity_id, name, category, amenity_business_key",
             f"amenity_id, name, category, {key('amenity_id', 'name')} AS amenity_business_key", "src_amenities")
silver_query("employees", "employee_id, host_id, email, role, joined_at, end_service_date, is_active, employee_business_key",
             f"employee_id, host_id, email, role, joined_at, end_service_date, is_currently_employed AS is_active, {key('employee_id', 'host_id')} AS employee_business_key", "s_employees")
silver_query("property_amenities", "property_id, amenity_id, property_amenity_business_key",
             f"property_id, amenity_id, {key('property_id', 'amenity_id')} AS property_amenity_business_key", "src_property_amenities")
silver_query("property_images", "image_id, property_id, url, sequence, is_primary, uploaded_at, property_image_business_key",
             f"image_id, property_id, url, {big('sequence')} AS sequence, is_primary, uploaded_at, {key('image_id', 'property_id')} AS property_image_business_key", "src_property_images")
silver_query("bookings", "booking_id, user_id, property_id, check_in, check_out, total_amount, nights_booked, avg_price_per_night, is_long_stay, is_high_value, booking_business_key",
             f"""booking_id, user_id, property_id, check_in, check_out, {dbl('total_amount')} AS total_amount, {big('check_out - check_in')} AS nights_booked,
             CAST((2 * CAST(total_amount * 10000 AS BIGINT) + 100 * (check_out - check_in)) // (200 * (check_out - check_in)) AS DOUBLE) / 100 AS avg_price_per_night,
             check_out - check_in > 7 AS is_long_stay, total_amount > 1000 AS is_high_value, {key('booking_id')} AS booking_business_key""", "s_bookings")
silver_query("booking_updates", "booking_update_id, booking_id, status, nights_booked, days_until_check_in, is_cancellation, is_date_change, booking_update_business_key",
             f"""booking_update_id, booking_id, status, {big('check_out - check_in')} AS nights_booked, {big('check_in - updated_at')} AS days_until_check_in,
             status = 'cancelled' AS is_cancellation, TRUE AS is_date_change, {key('booking_update_id', 'booking_id')} AS booking_update_business_key""", "s_booking_updates")
silver_query("payments", "payment_id, booking_id, amount, payment_method, status, payment_date, is_completed, is_refund, is_digital_payment, is_card_payment, payment_business_key",
             f"""payment_id, booking_id, {dbl('amount')} AS amount, payment_method, status, payment_date, status = 'completed' AS is_completed,
             status = 'refunded' AS is_refund, payment_method = 'paypal' AS is_digital_payment, payment_method = 'credit_card' AS is_card_payment,
             {key('payment_id', 'booking_id')} AS payment_business_key""", "s_payments")
silver_query("clickstream", "event, user_id, property_id, timestamp, device, referrer, is_mobile_event, is_paid_traffic, is_view_event, is_click_event, is_search_event",
             """event, user_id, property_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, device, referrer, device IN ('mobile','tablet') AS is_mobile_event,
             referrer = 'ad' AS is_paid_traffic, event = 'view' AS is_view_event, event = 'click' AS is_click_event, event = 'search' AS is_search_event""", "s_clickstream")
silver_query("page_views", "view_id, user_id, property_id, page_url, is_mobile_view, is_desktop_view, is_organic_traffic, is_paid_traffic, page_view_business_key",
             f"""view_id, user_id, property_id, page_url, device_type IN ('mobile','tablet') AS is_mobile_view, device_type = 'desktop' AS is_desktop_view,
             referrer IN ('google','direct') AS is_organic_traffic, referrer = 'ad' AS is_paid_traffic, {key('view_id', 'user_id')} AS page_view_business_key""", "s_page_views")
silver_query("reviews", "review_id, booking_id, rating, is_positive_review, is_negative_review, is_neutral_review, has_comment, is_updated, review_business_key",
             f"""review_id, booking_id, rating, rating >= 4 AS is_positive_review, rating <= 2 AS is_negative_review, rating > 2 AND rating < 4 AS is_neutral_review,
             coalesce(comment <> '', FALSE) AS has_comment, updated_at <> created_at AS is_updated, {key('review_id', 'booking_id')} AS review_business_key""", "s_reviews")
silver_query("support_logs", "ticket_id, user_id, support_agent_id, message_count, has_messages, has_agent_reply, has_negative_sentiment, support_ticket_business_key",
             f"""ticket_id, user_id, support_agent_id, {big('message_count')} AS message_count, message_count > 0 AS has_messages, agent_messages > 0 AS has_agent_reply,
             negative_messages > 0 AS has_negative_sentiment, {key('ticket_id', 'user_id')} AS support_ticket_business_key""", "src_support")
QUERIES["silver_weather"] = lambda cat: cat.silver("weather_forecasts").selectExpr(
    "locationKey", "date", "epochDate", "temperature.minimum.value AS low", "temperature.maximum.value AS high",
    "temperature_range", "is_precipitation_expected")
ORACLE["silver_weather"] = with_views(
    """SELECT "locationKey", date, "epochDate", "temperatureMin" AS low, "temperatureMax" AS high, temperature_range,
    is_precipitation_expected FROM src_forecasts""")
QUERIES["silver_weather_history"] = lambda cat: cat.silver("weather_history").selectExpr(
    "locationKey", "date", "epochDate", "temperature.minimum.value AS low", "temperature.maximum.value AS high",
    "temperature_range", "is_precipitation_expected")
ORACLE["silver_weather_history"] = with_views(
    """SELECT "locationKey", date, "epochDate", "temperatureMin" AS low, "temperatureMax" AS high, temperature_range,
    is_precipitation_expected FROM src_history""")


# --- sources and sinks --------------------------------------------------------------

def _ingest(cat):
    path = storage.scratch_path(cat.spark, "landed")
    rows = storage.ingest_table(cat.spark, f"{cat.root}/orders.parquet", path, "orders", cat.processed_at)
    landed = cat.spark.read.parquet(path)
    return landed.groupBy("_bronze_source_table", "_bronze_ingestion_timestamp").agg(
        F.count(F.lit(1)).alias("landed_rows"), F.max("o_orderkey").alias("max_key"), F.lit(rows).alias("reported_rows"))


QUERIES["ingest_table"] = _ingest
ORACLE["ingest_table"] = """SELECT 'orders' AS _bronze_source_table, '2001-08-02 00:00:00' AS _bronze_ingestion_timestamp,
    count(*) AS landed_rows, max(o_orderkey) AS max_key, count(*) AS reported_rows FROM orders"""


def _sink_overwrite(cat):
    path = storage.scratch_path(cat.spark, "overwritten")
    cat.raw("region").write.mode("overwrite").parquet(path)
    scored = cat.raw("nation").withColumn("scoring_date", F.lit(cat.as_of).cast("date"))
    return storage.write_table(scored, path)  # new columns replace the old layout


QUERIES["table_sink_overwrite"] = _sink_overwrite
ORACLE["table_sink_overwrite"] = """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name,
    CAST(n_regionkey AS BIGINT) AS n_regionkey, DATE '2001-08-02' AS scoring_date FROM nation"""


def _sink_merge(cat):
    """Merge late payments into a stored table, swap it in, read it back."""
    columns = ["booking_id", "payment_amount", "payment_method"]
    base = storage.scratch_path(cat.spark, "merged")
    early = cat.silver("payments").where("payment_date < DATE'2000-01-01'")
    storage.write_table(gold.latest_payments(early).select(*columns), base)
    staged = base + "-staged"
    newest = gold.latest_payments(cat.silver("payments")).select(*columns)
    storage.write_table(keys.upsert(cat.spark.read.parquet(base), newest, ["booking_id"]), staged)
    storage.swap_in(cat.spark, staged, base)
    return cat.spark.read.parquet(base)


QUERIES["table_sink_merge"] = _sink_merge
ORACLE["table_sink_merge"] = with_views(
    f"SELECT booking_id, {dbl('payment_amount')} AS payment_amount, payment_method FROM last_pay")


def _rows_source(cat):
    """Literal rule rows joined with what they describe: rows seen by each table's rules."""
    listed = quality.rules_frame(cat.spark, cat.rules_for("bookings"))
    seen = quality.violation_report(cat.derived("bookings"), cat.rules_for("bookings"))
    return listed.join(seen.select("rule_name", "row_count"), "rule_name").select("rule_name", "constraint_sql", "severity", "row_count")


QUERIES["rows_source"] = _rows_source
ORACLE["rows_source"] = with_views("""SELECT r.*, n.row_count FROM (VALUES
    ('valid_booking_id', 'booking_id IS NOT NULL', 'critical'), ('valid_user', 'user_id IS NOT NULL', 'critical'),
    ('valid_property', 'property_id IS NOT NULL', 'critical'),
    ('valid_check_in', 'check_in IS NOT NULL AND check_in >= DATE''1990-01-01''', 'critical'),
    ('valid_check_out', 'check_out IS NOT NULL AND check_out > check_in', 'critical'), ('valid_guests', 'guests_count >= 1', 'critical'),
    ('reasonable_guests', 'guests_count BETWEEN 1 AND 20', 'warning'), ('positive_amount', 'total_amount > 0', 'critical'),
    ('reasonable_amount', 'total_amount BETWEEN 10 AND 100000', 'warning'),
    ('reasonable_stay', 'DATEDIFF(check_out, check_in) BETWEEN 1 AND 365', 'warning')) AS r(rule_name, constraint_sql, severity),
    (SELECT count(*) AS row_count FROM src_bookings) n""")


def _conform(cat):
    shaped = keys.conform(cat.table("fact_booking_detail").drop("updated_at"), gold.FACT_BOOKING_DETAIL)
    return keys.null_report(shaped, gold.FACT_BOOKING_DETAIL)


QUERIES["conform"] = _conform
ORACLE["conform"] = with_views("SELECT * FROM (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in ("booking_id", "user_id", "property_id", "check_in_date", "check_out_date", "guests_count",
                                   "nights_booked", "total_amount", "status", "created_at", "is_cancelled", "is_business_booking"))
    + "]) AS column_name), (SELECT count(*) FILTER (booking_id IS NULL) AS null_rows FROM fact_booking_detail)")


# --- rules ----------------------------------------------------------------------------

RULE_TABLES = ["users", "hosts", "destinations", "countries", "properties", "amenities", "employees", "bookings",
               "booking_updates", "payments", "reviews", "clickstream", "page_views", "support_logs", "weather_forecasts", "weather_history"]


def _rules_with_hits(cat):
    """The rule table with, for every rule, the rows its table failed."""
    parts = []
    for t in RULE_TABLES:
        rules = cat.rules_for(t)
        report = quality.violation_report(cat.derived(t), rules)
        parts.append(report.withColumn("table_name", F.lit(rules[0].table)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "rule_name", "severity", "row_count", "violations")


QUERIES["dq_rules"] = _rules_with_hits
_FAILS = {
    "users": ("src_users", [("valid_user_id", "c", "user_id IS NULL"), ("valid_email", "c", "instr(email, '@') = 0"), ("valid_name", "c", "length(name) = 0"),
        ("valid_created_date", "c", "created_at < DATE '1990-01-01'"), ("recent_user", "w", "created_at < DATE '1996-08-02'")]),
    "hosts": ("src_hosts", [("valid_host_id", "c", "host_id IS NULL"), ("valid_email", "c", "instr(email, '@') = 0"), ("valid_rating", "w", "rating < 1 OR rating > 5")]),
    "destinations": ("src_destinations", [("valid_destination_id", "c", "destination_id IS NULL"), ("valid_destination_name", "c", "length(destination) = 0"), ("valid_country", "c", "country IS NULL")]),
    "countries": ("src_countries", [("valid_country", "c", "length(country) = 0"), ("valid_country_code", "c", "length(country_code) <> 2")]),
    "properties": ("src_properties", [("valid_property_id", "c", "property_id IS NULL"), ("valid_host", "c", "host_id IS NULL"), ("valid_destination", "c", "destination_id IS NULL"),
        ("positive_base_price", "c", "base_price <= 0"), ("reasonable_price", "w", "base_price < 10 OR base_price > 10000"), ("valid_guests", "c", "max_guests < 1"),
        ("reasonable_guests", "w", "max_guests > 20"), ("valid_coordinates", "w", "abs(property_latitude) > 90 OR abs(property_longitude) > 180")]),
    "amenities": ("src_amenities", [("valid_amenity_id", "c", "amenity_id IS NULL"), ("valid_amenity_name", "c", "length(name) = 0")]),
    "employees": ("src_employees", [("valid_employee_id", "c", "employee_id IS NULL"), ("valid_host", "c", "host_id IS NULL"),
        ("valid_joined_date", "c", "joined_at < DATE '1990-01-01'"), ("valid_employment_status", "w", "end_service_date < joined_at")]),
    "bookings": ("src_bookings", [("valid_booking_id", "c", "booking_id IS NULL"), ("valid_user", "c", "user_id IS NULL"), ("valid_property", "c", "property_id IS NULL"),
        ("valid_check_in", "c", "check_in < DATE '1990-01-01'"), ("valid_check_out", "c", "check_out <= check_in"), ("valid_guests", "c", "guests_count < 1"),
        ("reasonable_guests", "w", "guests_count NOT BETWEEN 1 AND 20"), ("positive_amount", "c", "total_amount <= 0"),
        ("reasonable_amount", "w", "total_amount NOT BETWEEN 10 AND 100000"), ("reasonable_stay", "w", "check_out - check_in NOT BETWEEN 1 AND 365")]),
    "booking_updates": ("src_booking_updates", [("valid_booking_update_id", "c", "booking_update_id IS NULL"), ("valid_booking", "c", "booking_id IS NULL"),
        ("valid_dates", "c", "check_out <= check_in"), ("update_after_creation", "w", "updated_at < created_at")]),
    "payments": ("src_payments", [("valid_payment_id", "c", "payment_id IS NULL"), ("valid_booking", "c", "booking_id IS NULL"), ("positive_amount", "c", "amount <= 0"),
        ("reasonable_amount", "w", "amount NOT BETWEEN 1 AND 100000"), ("valid_payment_method", "c", "payment_method IS NULL"), ("valid_payment_date", "c", "payment_date < DATE '1990-01-01'")]),
    "reviews": ("src_reviews", [("valid_review_id", "c", "review_id IS NULL"), ("valid_booking", "c", "booking_id IS NULL"), ("valid_property", "c", "property_id IS NULL"),
        ("valid_user", "c", "user_id IS NULL"), ("valid_rating", "c", "rating < 1 OR rating > 5"), ("has_comment_or_rating", "w", "comment IS NULL AND rating IS NULL")]),
    "clickstream": ("src_clickstream", [("valid_event", "c", "length(event) = 0"), ("valid_timestamp", "c", "timestamp < DATE '1990-01-01'"), ("recent_event", "w", "timestamp < DATE '2001-05-04'")]),
    "page_views": ("src_page_views", [("valid_view_id", "c", "view_id IS NULL"), ("valid_timestamp", "c", "timestamp < DATE '1990-01-01'"),
        ("valid_page_url", "c", "length(page_url) = 0"), ("recent_page_view", "w", "timestamp < DATE '2001-05-04'")]),
    "customer_support_logs": ("src_support", [("valid_ticket_id", "c", "length(ticket_id) = 0"), ("valid_user", "c", "user_id IS NULL"),
        ("valid_created_date", "c", "created_at IS NULL"), ("has_messages", "w", "message_count = 0")]),
}
_SEVERITY = {"c": "critical", "w": "warning"}


def _fail_rows(table: str) -> str:
    view, entries = _FAILS[table]
    return " UNION ALL ".join(
        f"SELECT 'silver_{table}' AS table_name, '{n}' AS rule_name, '{_SEVERITY[s]}' AS severity, count(*) AS row_count,"
        f" count(*) FILTER ({bad}) AS violations FROM {view}" for n, s, bad in entries)


_WEATHER_RULES = " UNION ALL ".join(
    f"SELECT 'silver_{t}_daily_metric' AS table_name, 'has_data' AS rule_name, 'warning' AS severity, count(*) AS row_count, 0 AS violations FROM {v}"
    for t, v in (("forecast", "src_forecasts"), ("historical", "src_history")))
ORACLE["dq_rules"] = with_views(" UNION ALL ".join(_fail_rows(t) for t in _FAILS) + " UNION ALL " + _WEATHER_RULES)

QUERIES["dq_load_rules"] = lambda cat: quality.violation_report(
    cat.derived("payments"),
    quality.load_rules(quality.rules_frame(cat.spark, cat.rules), "silver_payments", quality.CRITICAL)).drop("severity")
ORACLE["dq_load_rules"] = with_views(
    f"SELECT rule_name, row_count, violations FROM ({_fail_rows('payments')}) WHERE severity = 'critical'")

QUERIES["dq_expect_or_drop"] = lambda cat: cat.silver("reviews").select("review_id", "rating", "user_id")
ORACLE["dq_expect_or_drop"] = with_views("SELECT review_id, rating, user_id FROM s_reviews")


def _warn(cat):
    """Observed warning counters next to the rows that flowed through."""
    from pyspark.sql import Observation

    watch = Observation("property_warnings")
    rules = quality.warnings(cat.rules_for("properties"))
    flow = quality.observe_warnings(cat.silver("properties"), watch, rules)
    kept = flow.groupBy("property_type").agg(F.count(F.lit(1)).alias("kept_rows"))
    kept = storage.materialize(kept, "warned")
    seen = watch.get
    return kept.withColumns({r.name: F.lit(seen[r.name]) for r in rules}).withColumn("rows_seen", F.lit(seen["rows_seen"]))


QUERIES["dq_expect_warn"] = _warn
ORACLE["dq_expect_warn"] = with_views("""SELECT property_type, count(*) AS kept_rows, any_value(a) AS reasonable_price, any_value(b) AS reasonable_guests,
    any_value(c) AS valid_coordinates, any_value(n) AS rows_seen FROM s_properties, (SELECT count(*) FILTER (base_price < 10 OR base_price > 10000) AS a,
    count(*) FILTER (max_guests > 20) AS b, count(*) FILTER (abs(property_latitude) > 90 OR abs(property_longitude) > 180) AS c, count(*) AS n
    FROM s_properties) GROUP BY property_type""")

QUERIES["dq_quarantine_condition"] = lambda cat: cat.source("properties").withColumn(
    "is_quarantined", quality.quarantine_condition(cat.rules_for("properties"))).groupBy("is_quarantined").agg(
    F.count(F.lit(1)).alias("row_count"), F.sum("base_price").alias("total_price"))
ORACLE["dq_quarantine_condition"] = with_views(
    f"SELECT base_price <= 0 AS is_quarantined, count(*) AS row_count, {dbl('sum(base_price)')} AS total_price FROM src_properties GROUP BY 1")

_BOOKING_REASON = """CASE WHEN check_out <= check_in THEN 'CRITICAL: Check-out not after check-in'
    WHEN guests_count < 1 THEN 'CRITICAL: Invalid guest count' WHEN total_amount <= 0 THEN 'CRITICAL: Invalid total amount'
    ELSE 'CRITICAL: Multiple validation failures' END"""
_BAD_BOOKINGS = "src_bookings WHERE NOT (check_in >= DATE '1990-01-01' AND check_out > check_in AND guests_count >= 1 AND total_amount > 0)"
_PAYMENT_REASON = """CASE WHEN amount <= 0 THEN 'CRITICAL: Invalid payment amount' WHEN payment_method IS NULL THEN 'CRITICAL: Missing payment method'
    ELSE 'CRITICAL: Multiple validation failures' END"""
_BAD_PAYMENTS = "src_payments WHERE amount <= 0 OR payment_method IS NULL OR payment_date < DATE '1990-01-01'"
QUERIES["quarantine_bookings"] = lambda cat: cat.quarantined("bookings").select(
    "booking_id", "user_id", "property_id", "check_in", "check_out", "guests_count", "total_amount", "quarantine_reason")
ORACLE["quarantine_bookings"] = with_views(f"""SELECT booking_id, user_id, property_id, check_in, check_out, {big('guests_count')} AS guests_count,
    {dbl('total_amount')} AS total_amount, {_BOOKING_REASON} AS quarantine_reason FROM {_BAD_BOOKINGS}""")
QUERIES["quarantine_payments"] = lambda cat: cat.quarantined("payments").select(
    "payment_id", "booking_id", "amount", "payment_method", "payment_date", "quarantine_reason")
ORACLE["quarantine_payments"] = with_views(f"""SELECT payment_id, booking_id, {dbl('amount')} AS amount, payment_method, payment_date,
    {_PAYMENT_REASON} AS quarantine_reason FROM {_BAD_PAYMENTS}""")

QUERIES["dq_booking_metrics"] = lambda cat: quality_reports.booking_metrics(cat.derived("bookings"), cat.rules_for("bookings"))
_BOOKING_METRICS = f"""SELECT *, s + q AS total_records, round(s * 100.0 / (s + q), 2) AS pass, round(q * 100.0 / (s + q), 2) AS quarantine_rate
    FROM (SELECT count(*) AS s, count(*) FILTER (check_out - check_in > 7) AS l, count(*) FILTER (total_amount > 1000) AS h,
    {mean('total_amount')} AS a, {mean('check_out - check_in')} AS n FROM s_bookings), (SELECT count(*) AS q FROM {_BAD_BOOKINGS})"""
ORACLE["dq_booking_metrics"] = with_views(f"""SELECT s AS silver_record_count, l AS long_stay_count, h AS high_value_count, a AS avg_booking_amount,
    n AS avg_nights_booked, q AS quarantine_record_count, total_records, {dbl('pass')} AS silver_pass_rate, {dbl('quarantine_rate')} AS quarantine_rate
    FROM ({_BOOKING_METRICS})""")
QUERIES["dq_payment_metrics"] = lambda cat: quality_reports.payment_metrics(cat.derived("payments"), cat.rules_for("payments"))
_PAYMENT_METRICS = f"""SELECT *, s + q AS total_records, round(s * 100.0 / (s + q), 2) AS pass, round(q * 100.0 / (s + q), 2) AS quarantine_rate
    FROM (SELECT count(*) AS s, count(*) FILTER (status = 'completed') AS c, count(*) FILTER (status = 'refunded') AS r,
    count(*) FILTER (payment_method = 'paypal') AS d, {dbl('sum(amount)')} AS t, {mean('amount')} AS a FROM s_payments), (SELECT count(*) AS q FROM {_BAD_PAYMENTS})"""
ORACLE["dq_payment_metrics"] = with_views(f"""SELECT s AS silver_record_count, c AS completed_count, r AS refund_count, d AS digital_payment_count,
    t AS total_payment_amount, a AS avg_payment_amount, q AS quarantine_record_count, total_records, {dbl('pass')} AS silver_pass_rate,
    {dbl('quarantine_rate')} AS quarantine_rate FROM ({_PAYMENT_METRICS})""")


def _integrity(cat):
    """All four checks in one pass over each table."""
    return quality_reports.referential_integrity(*[cat.silver(t) for t in ("bookings", "users", "properties", "payments", "reviews")])


QUERIES["dq_referential_integrity"] = _integrity
_INTEGRITY = """SELECT check_name, n AS orphaned_records, CASE WHEN n = 0 THEN 'PASS' WHEN n < 10 THEN 'WARNING' ELSE 'FAIL' END AS status FROM (
    SELECT 'bookings_to_users' AS check_name, count(*) AS n FROM s_bookings ANTI JOIN s_users USING (user_id)
    UNION ALL SELECT 'bookings_to_properties', count(*) FROM s_bookings ANTI JOIN s_properties USING (property_id)
    UNION ALL SELECT 'payments_to_bookings', count(*) FROM s_payments ANTI JOIN s_bookings USING (booking_id)
    UNION ALL SELECT 'reviews_to_bookings', count(*) FROM s_reviews ANTI JOIN s_bookings USING (booking_id))"""
ORACLE["dq_referential_integrity"] = with_views(_INTEGRITY)


def _gate(cat):
    """The gate's verdict as a row: which checks block the run."""
    report = _integrity(cat)
    try:
        quality_reports.integrity_gate(report)
        blocked = ""
    except quality_reports.IntegrityError as error:
        blocked = str(error).split(": ", 1)[1]
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("checks")).withColumn("blocked_by", F.lit(blocked))


QUERIES["dq_ri_gate"] = _gate
ORACLE["dq_ri_gate"] = with_views(f"""SELECT status, count(*) AS checks, any_value(blocked_by) AS blocked_by FROM ({_INTEGRITY}),
    (SELECT coalesce(string_agg(check_name, ', ' ORDER BY check_name), '') AS blocked_by FROM ({_INTEGRITY}) WHERE status = 'FAIL') GROUP BY status""")


def _health(cat):
    stamp = "processed_timestamp"
    kinds = {"users": "dimension", "hosts": "dimension", "destinations": "dimension", "properties": "dimension", "bookings": "fact",
             "payments": "fact", "reviews": "fact", "clickstream": "fact", "page_views": "fact"}
    # Age of each table is that of its newest business date where it has one.
    newest = {"users": "created_at", "hosts": "joined_at", "properties": "created_at", "bookings": "created_at", "payments": "payment_date",
              "reviews": "created_at", "clickstream": "timestamp", "page_views": "timestamp"}
    tables = {}
    for t, kind in kinds.items():
        frame = cat.silver(t)
        frame = frame.withColumn(stamp, F.date_trunc("DAY", F.col(newest[t])).cast("timestamp_ntz")) if t in newest else frame
        tables[f"silver_{t}"] = (frame, kind, stamp)
    for t, day in (("bookings", "check_in"), ("payments", "payment_date")):
        frame = cat.quarantined(t).withColumn("quarantine_timestamp", F.col(day).cast("timestamp_ntz"))
        tables[f"silver_{t}_quarantine"] = (frame, "quarantine", "quarantine_timestamp")
    return quality_reports.overall_health(tables, cat.processed_at)


QUERIES["dq_overall_health"] = _health
_H = {"users": ("s_users", "created_at", "dimension"), "hosts": ("s_hosts", "joined_at", "dimension"), "destinations": ("src_destinations", "DATE '2001-08-02'", "dimension"),
      "properties": ("s_properties", "created_at", "dimension"), "bookings": ("s_bookings", "created_at", "fact"), "payments": ("s_payments", "payment_date", "fact"),
      "reviews": ("s_reviews", "created_at", "fact"), "clickstream": ("s_clickstream", "timestamp", "fact"), "page_views": ("s_page_views", "timestamp", "fact"),
      "bookings_quarantine": (_BAD_BOOKINGS, "check_in", "quarantine"), "payments_quarantine": (_BAD_PAYMENTS, "payment_date", "quarantine")}
ORACLE["dq_overall_health"] = with_views("""SELECT table_name, table_type, record_count, strftime(d, '%Y-%m-%d %H:%M:%S') AS last_processed_timestamp,
    CAST((DATE '2001-08-02' - d) * 1440 AS DOUBLE) AS minutes_since_update, CASE WHEN (DATE '2001-08-02' - d) * 1440 < 60 THEN 'CURRENT'
    WHEN (DATE '2001-08-02' - d) * 1440 < 1440 THEN 'STALE' ELSE 'VERY_STALE' END AS data_freshness_status FROM (""" + " UNION ALL ".join(
    f"SELECT 'silver_{t}' AS table_name, '{kind}' AS table_type, count(*) AS record_count, max(CAST({day} AS DATE)) AS d FROM {view}" for t, (view, day, kind) in _H.items()) + ")")

def _guarded(cat, read):
    """Every table that has rules, under the name the rules use."""
    return {cat.rules_for(t)[0].table: read(t) for t in RULE_TABLES}


def _table_counts(cat):
    tables = _guarded(cat, cat.silver)
    return quality_reports.table_counts(tables, [*tables, "silver_missing_table"])


QUERIES["dq_table_counts"] = _table_counts
_COUNTS = {"users": "s_users", "hosts": "s_hosts", "destinations": "src_destinations", "countries": "src_countries WHERE length(country_code) = 2", "properties": "s_properties",
           "amenities": "src_amenities", "employees": "s_employees", "bookings": "s_bookings", "booking_updates": "s_booking_updates", "payments": "s_payments",
           "reviews": "s_reviews", "clickstream": "s_clickstream", "page_views": "s_page_views", "customer_support_logs": "src_support",
           "forecast_daily_metric": "src_forecasts", "historical_daily_metric": "src_history"}
ORACLE["dq_table_counts"] = with_views("SELECT table_name, TRUE AS table_exists, n AS record_count, CASE WHEN n = 0 THEN 'EMPTY' ELSE 'OK' END AS status FROM ("
    + " UNION ALL ".join(f"SELECT 'silver_{t}' AS table_name, count(*) AS n FROM {v}" for t, v in _COUNTS.items())
    + ") UNION ALL SELECT 'silver_missing_table', FALSE, 0, 'MISSING'")


def _coverage(cat):
    """Rules per table and severity, with the size of the table they guard."""
    covered = quality_reports.rule_coverage(quality.rules_frame(cat.spark, cat.rules))
    tables = _guarded(cat, cat.source)
    counts = quality_reports.table_counts(tables, list(tables))
    return covered.join(counts.select("table_name", "record_count"), "table_name", "left")


QUERIES["dq_rule_coverage"] = _coverage
ORACLE["dq_rule_coverage"] = with_views("SELECT table_name, severity, count(*) AS rule_count, any_value(row_count) AS record_count FROM ("
    + " UNION ALL ".join(_fail_rows(t) for t in _FAILS) + " UNION ALL " + _WEATHER_RULES + ") GROUP BY 1, 2")

QUERIES["dq_quarantine_grade"] = lambda cat: quality_reports.quarantine_grade(
    quality_reports.booking_metrics(cat.derived("bookings"), cat.rules_for("bookings")), "bookings").unionByName(
    quality_reports.quarantine_grade(quality_reports.payment_metrics(cat.derived("payments"), cat.rules_for("payments")), "payments"))
ORACLE["dq_quarantine_grade"] = with_views("SELECT entity, s AS silver_record_count, q AS quarantine_record_count, CAST(r AS DOUBLE) AS quarantine_rate, "
    "CASE WHEN r > 10 THEN 'WARNING' WHEN r > 5 THEN 'CAUTION' ELSE 'GOOD' END AS grade FROM ("
    f"SELECT 'bookings' AS entity, s, q, quarantine_rate AS r FROM ({_BOOKING_METRICS}) UNION ALL SELECT 'payments', s, q, quarantine_rate FROM ({_PAYMENT_METRICS}))")

QUERIES["quarantine_top_reasons"] = lambda cat: quality_reports.top_reasons(
    cat.quarantined("bookings").select("quarantine_reason").unionByName(cat.quarantined("payments").select("quarantine_reason")))
ORACLE["quarantine_top_reasons"] = with_views(f"""SELECT quarantine_reason, count(*) AS failure_count,
    CAST(count(*) * 100.0 / sum(count(*)) OVER () AS DOUBLE) AS failure_share,
    CASE WHEN quarantine_reason LIKE '%Missing%' THEN 'A required value never arrived: look at the landed rows' WHEN quarantine_reason LIKE '%Invalid%'
    THEN 'A value is out of bounds: look at its type and limits' ELSE 'Review the corresponding rule' END AS advice
    FROM (SELECT {_BOOKING_REASON} AS quarantine_reason FROM {_BAD_BOOKINGS} UNION ALL SELECT {_PAYMENT_REASON} FROM {_BAD_PAYMENTS})
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")

CHECKS = [
    {"name": "method_given", "criticality": "error", "check": {"function": "is_not_null_and_not_empty", "arguments": {"column": "payment_method"}}},
    {"name": "positive_amount", "criticality": "error", "check": {"function": "is_greater_than", "arguments": {"column": "amount", "value": 0}}},
    {"name": "usual_amount", "criticality": "warn", "check": {"function": "is_between", "arguments": {"column": "amount", "min_value": 1000, "max_value": 50000}}},
    {"name": "recent_payment", "criticality": "warn", "check": {"function": "is_greater_than_or_equal_to", "arguments": {"column": "payment_date", "value": "1996-01-01"}}},
    {"name": "not_huge", "criticality": "warn", "check": {"function": "is_less_than_or_equal_to", "arguments": {"column": "amount", "value": 90000}}},
]


def _diagnostics(cat):
    valid, invalid = quality.split_diagnosed(quality.diagnose(cat.source("payments"), CHECKS))
    both = valid.withColumn("outcome", F.lit("valid")).unionByName(invalid.withColumn("outcome", F.lit("invalid")))
    return both.select("payment_id", "amount", "outcome", F.array_join(F.transform("_failures", lambda f: f["check_name"]), ",").alias("failed_checks"))


QUERIES["dqx_row_diagnostics"] = _diagnostics
ORACLE["dqx_row_diagnostics"] = with_views("""SELECT payment_id, CAST(amount AS DOUBLE) AS amount,
    CASE WHEN payment_method IS NULL OR amount <= 0 THEN 'invalid' ELSE 'valid' END AS outcome,
    concat_ws(',', CASE WHEN payment_method IS NULL THEN 'method_given' END, CASE WHEN amount <= 0 THEN 'positive_amount' END,
    CASE WHEN amount NOT BETWEEN 1000 AND 50000 THEN 'usual_amount' END, CASE WHEN payment_date < DATE '1996-01-01' THEN 'recent_payment' END,
    CASE WHEN amount > 90000 THEN 'not_huge' END) AS failed_checks FROM src_payments""")
