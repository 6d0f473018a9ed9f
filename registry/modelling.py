"""Dimensions, facts, merges, checks and join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from innsight.functions.shared import current
from innsight.operators import history, keys, ordered
from innsight.plans import gold
from innsight.plans.merges import merge_table, merge_versions
from innsight.sources.storage import materialize, scratch_path
from oracle.base import AS_OF, add_view, big, dbl, with_views

QUERIES: dict = {}
ORACLE: dict = {}


def minimum_slice(cat):
    """Raw orders to monthly revenue without any stored table."""
    from innsight.functions.revenue import get_revenue_by_period

    return get_revenue_by_period(cat.plan("fact_booking_daily"), "1995-01-01", "2001-12-31", "month")


QUERIES["slice_monthly_revenue"] = minimum_slice

# --- keyed operators ---------------------------------------------------------------------
QUERIES["dedup_latest"] = lambda cat: keys.dedup_latest(
    cat.silver("payments"), ["payment_id"], [F.desc("payment_date"), F.desc("amount"), F.desc("payment_method"), F.desc("status")]
).select("payment_id", "booking_id", "amount", "payment_date", "payment_method")
ORACLE["dedup_latest"] = with_views(f"""SELECT payment_id, booking_id, {dbl('amount')} AS amount, payment_date, payment_method FROM (
    SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY payment_date DESC, amount DESC, payment_method DESC, status DESC) AS rn FROM s_payments) WHERE rn = 1""")

QUERIES["surrogate_key"] = lambda cat: cat.table("dim_user").select("user_id", "user_key", "effective_from", "is_current")
ORACLE["surrogate_key"] = with_views(f"SELECT user_id, md5(user_id || '||2001-08-02') AS user_key, {AS_OF} AS effective_from, is_current FROM dim_user")


def _upsert(cat):
    """Fact of bookings last updated before 2000, merged with everything changed since 1999."""
    columns = ["booking_id", "status", "updated_at", "total_amount", "is_cancelled"]
    fact = cat.table("fact_booking_detail").select(*columns)
    target = fact.where("updated_at < DATE'2000-01-01'").withColumn("status", F.lit("stale"))
    source = fact.where("updated_at >= DATE'1999-01-01'").withColumn("total_amount", (F.col("total_amount") + 1).cast("decimal(18,2)"))
    return keys.upsert(target, source, ["booking_id"], update=["status", "updated_at", "is_cancelled"])


QUERIES["upsert"] = _upsert
ORACLE["upsert"] = with_views(f"""SELECT booking_id, CASE WHEN updated_at >= DATE '1999-01-01' THEN status ELSE 'stale' END AS status, updated_at,
    {dbl("CASE WHEN updated_at < DATE '2000-01-01' THEN total_amount ELSE total_amount + 1 END")} AS total_amount, is_cancelled FROM fact_booking_detail""")


def _merge_fact(cat):
    """Early bookings with a stale status and an unset guest count, then merged with the whole fact."""
    fact = cat.table("fact_booking_detail")
    path = scratch_path(cat.spark, "merged-fact")
    early = fact.where("updated_at < DATE'2000-01-01'").withColumns({"status": F.lit("stale"), "guests_count": F.lit(-1)})
    merge_table(early, path, "fact_booking_detail")
    return merge_table(fact, path, "fact_booking_detail").select("booking_id", "status", "guests_count", "payment_amount", "payment_method", "is_cancelled")


QUERIES["merge_fact_booking_detail"] = _merge_fact
ORACLE["merge_fact_booking_detail"] = with_views(f"""SELECT booking_id, status, {big("CASE WHEN updated_at < DATE '2000-01-01' THEN -1 ELSE guests_count END")} AS guests_count,
    {dbl('payment_amount')} AS payment_amount, payment_method, is_cancelled FROM fact_booking_detail""")


def _merge_daily(cat):
    """Daily fact loaded up to 1999 with zeroed counts, then merged: every measure is refreshed."""
    fact = cat.table("fact_booking_daily")
    path = scratch_path(cat.spark, "merged-daily")
    merge_table(fact.where("check_in_date < DATE'2000-01-01'").withColumns({"booking_count": F.lit(0).cast("long"), "total_guests": F.lit(0).cast("long")}), path, "fact_booking_daily")
    return merge_table(fact, path, "fact_booking_daily").groupBy("check_in_date").agg(
        F.count(F.lit(1)).alias("properties"), F.sum("booking_count").alias("bookings"), F.sum("total_guests").alias("guests"), F.sum("total_booking_value").alias("value"))


QUERIES["merge_fact_booking_daily"] = _merge_daily
ORACLE["merge_fact_booking_daily"] = with_views(f"""SELECT check_in_date, count(*) AS properties, {big('sum(booking_count)')} AS bookings, {big('sum(total_guests)')} AS guests, {dbl('sum(total_booking_value)')} AS value
    FROM fact_booking_daily GROUP BY 1""")


def _scd1(cat):
    dim = cat.table("dim_destination")
    batch = dim.where("destination_id >= 10").unionByName(
        dim.where("destination_id < 3").withColumns(
            {"destination_id": F.col("destination_id") + 1000, "destination_key": keys.surrogate_key(F.col("destination_id") + 1000)}
        )
    ).withColumn("description", F.concat(F.lit("new "), "description"))
    return history.scd1_upsert(dim, batch, ["destination_id"])


QUERIES["scd1_destination"] = _scd1
ORACLE["scd1_destination"] = with_views("""SELECT md5(CAST(destination_id AS VARCHAR)) AS destination_key, destination_id, destination, country, state_or_province,
    state_or_province_code, CASE WHEN destination_id >= 10 THEN 'new ' ELSE '' END || description AS description FROM (
    SELECT * FROM src_destinations UNION ALL SELECT * REPLACE (destination_id + 1000 AS destination_id) FROM src_destinations WHERE destination_id < 3)""")

CHANGE_DAY = "2001-09-01"


def _versions(dim, key, tracked, key_name, edits, new_rows, stored=None):
    """Apply a change batch, store the dimension, apply it again: the second run must change nothing.

    ``stored`` names the dimension for a merge into a stored table instead.
    """
    base = dim.drop(key_name, "effective_from", "effective_to", "is_current")
    batch = base.withColumns(edits).unionByName(new_rows(base)).withColumn("since", F.lit(CHANGE_DAY).cast("date"))
    if stored:
        path = scratch_path(dim.sparkSession, f"merged-{stored}")
        merge_versions(dim, path, stored, "since")
        for _ in range(2):
            out = merge_versions(batch, path, stored, "since")
        return out
    once = materialize(history.scd2_apply(dim, batch, key, tracked, key_name, "since"), key_name)
    return history.scd2_apply(once, batch, key, tracked, key_name, "since")


def _scd2_user(cat, stored=None):
    dim = cat.table("dim_user")
    out = _versions(
        dim, "user_id", ["country", "user_type", "is_business"], "user_key",
        {"user_type": F.when(F.col("user_id") % 10 == 0, "vip").otherwise(F.col("user_type")), "name": F.upper("name")},
        lambda b: b.where("user_id < 5").withColumn("user_id", F.col("user_id") + 10_000_000), stored,
    )
    return out.select("user_key", "user_id", "name", "user_type", "effective_from", "effective_to", "is_current")


def _scd2_sql(view, key, columns, changed, edits, extra):
    """Versions after one change day: closed + untouched + opened rows."""
    base = ", ".join(columns)
    edited = ", ".join(edits.get(c, c) + f" AS {c}" for c in columns)
    return f"""SELECT md5({key} || '||' || CAST(effective_from AS VARCHAR)) AS version_key, * FROM (
        SELECT {key}, {base}, {AS_OF} AS effective_from, CASE WHEN {changed} THEN DATE '{CHANGE_DAY}' END AS effective_to, NOT ({changed}) AS is_current FROM {view}
        UNION ALL SELECT {key}, {edited}, DATE '{CHANGE_DAY}', NULL, TRUE FROM {view} WHERE {changed}
        UNION ALL SELECT {key} + 10000000, {base}, DATE '{CHANGE_DAY}', NULL, TRUE FROM {view} WHERE {extra})"""


QUERIES["scd2_user"] = _scd2_user
ORACLE["scd2_user"] = with_views("SELECT version_key AS user_key, * EXCLUDE (version_key) FROM (" + _scd2_sql(
    "dim_user", "user_id", ["name", "user_type"], "user_id % 10 = 0", {"name": "upper(name)", "user_type": "'vip'"}, "user_id < 5") + ")")


def _scd2_host(cat, stored=None):
    out = _versions(
        cat.table("dim_host"), "host_id", ["is_verified", "is_active", "rating"], "host_key",
        {"is_verified": F.col("is_verified") | (F.col("host_id") % 3 == 0)},
        lambda b: b.where("host_id < 2").withColumn("host_id", F.col("host_id") + 10_000_000), stored,
    )
    return out.select("host_key", "host_id", "is_verified", "rating", "effective_from", "effective_to", "is_current")


QUERIES["scd2_host"] = _scd2_host
ORACLE["scd2_host"] = with_views("SELECT version_key AS host_key, * EXCLUDE (version_key) FROM (" + _scd2_sql(
    "dim_host", "host_id", ["is_verified", "rating"], "host_id % 3 = 0", {"is_verified": "TRUE"}, "host_id < 2") + ")")


def _scd2_property(cat, stored=None):
    out = _versions(
        cat.table("dim_property"), "property_id", ["base_price", "property_type", "host_id"], "property_key",
        {"base_price": F.when(F.col("property_id") % 4 == 1, (F.col("base_price") + 10).cast("decimal(18,2)")).otherwise(F.col("base_price"))},
        lambda b: b.where("property_id BETWEEN 1 AND 3").withColumn("property_id", F.col("property_id") + 10_000_000), stored,
    )
    return out.select("property_key", "property_id", "base_price", "effective_from", "effective_to", "is_current")


QUERIES["scd2_property"] = _scd2_property
ORACLE["scd2_property"] = with_views("SELECT version_key AS property_key, * EXCLUDE (version_key) REPLACE (CAST(base_price AS DOUBLE) AS base_price) FROM (" + _scd2_sql(
    "dim_property", "property_id", ["base_price"], "property_id % 4 = 1", {"base_price": "base_price + 10"}, "property_id BETWEEN 1 AND 3") + ")")


for _name, _build in (("user", _scd2_user), ("host", _scd2_host), ("property", _scd2_property)):
    QUERIES[f"merge_dim_{_name}"] = lambda c, b=_build, n=_name: b(c, f"dim_{n}")
    ORACLE[f"merge_dim_{_name}"] = ORACLE[f"scd2_{_name}"]


def _merge_twice(cat, name, early, columns):
    """A part of the table with changed values, then merged twice with the whole table."""
    table, path = cat.table(name), scratch_path(cat.spark, f"merged-{name}")
    merge_table(early(table), path, name)
    for _ in range(2):
        out = merge_table(table, path, name)
    return out.select(*columns)


QUERIES["merge_dim_destination"] = lambda c: _merge_twice(
    c, "dim_destination", lambda t: t.where("destination_id < 9").withColumn("description", F.lit("old")), ["destination_id", "destination", "country", "description"])
ORACLE["merge_dim_destination"] = with_views("SELECT destination_id, destination, country, description FROM src_destinations")
QUERIES["merge_dim_weather_location"] = lambda c: _merge_twice(
    c, "dim_weather_location", lambda t: t.where("locationKey < 'L2'").withColumn("localizedName", F.lit("old")), ["locationKey", "localizedName"])
ORACLE["merge_dim_weather_location"] = "SELECT 'L' || n_nationkey AS \"locationKey\", n_name AS \"localizedName\" FROM nation"
QUERIES["merge_fact_property_engagement"] = lambda c: _merge_twice(
    c, "fact_property_engagement", lambda t: t.where("property_id % 3 = 0").withColumn("view_count", F.lit(-1).cast("long")),
    ["property_id", "engagement_date", "view_count", "unique_user_views", "click_count", "search_count"])
ORACLE["merge_fact_property_engagement"] = with_views(
    f"SELECT property_id, engagement_date, {', '.join(f'{big(x)} AS {x}' for x in ('view_count', 'unique_user_views', 'click_count', 'search_count'))} FROM fact_property_engagement")
QUERIES["merge_fact_weather_daily"] = lambda c: _merge_twice(
    c, "fact_weather_daily", lambda t: t.where("hoursOfSun > 3").withColumn("temperatureMin", F.lit(-99.0)), ["locationKey", "date", "temperatureMin", "temperatureMax", "is_precipitation_expected"])
ORACLE["merge_fact_weather_daily"] = with_views(
    'SELECT "locationKey", date, "temperatureMin", "temperatureMax", is_precipitation_expected FROM fact_weather_daily')


def history_sql(source: str, key: str, tracked: list[str]) -> str:
    same = " AND ".join(f"p_{c} IS NOT DISTINCT FROM {c}" for c in tracked)
    lags = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in tracked)
    cols = ", ".join(tracked)
    return f"""SELECT {key}, {cols}, changed_at AS effective_from, lead(changed_at) OVER (PARTITION BY {key} ORDER BY changed_at) AS effective_to,
        lead(changed_at) OVER (PARTITION BY {key} ORDER BY changed_at) IS NULL AS is_current FROM (
        SELECT *, {lags}, lag(changed_at) OVER w AS p_at FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}, changed_at
            ORDER BY change_id DESC, {', '.join(c + ' DESC' for c in tracked)}) AS rn FROM {source}) WHERE rn = 1)
        WINDOW w AS (PARTITION BY {key} ORDER BY changed_at)) WHERE p_at IS NULL OR NOT ({same})"""


add_view("user_change_log", """SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS changed_at, o_orderkey AS change_id,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'business' ELSE 'individual' END AS user_type,
    CASE WHEN o_orderstatus = 'P' THEN 'moved' ELSE 'home' END AS residence FROM orders""")
add_view("host_change_log", """SELECT l_suppkey AS host_id, CAST(l_shipdate AS DATE) AS changed_at,
    (l_orderkey * 10 + l_linenumber) * 10000 + l_partkey % 10000 AS change_id, l_returnflag = 'R' AS is_verified, l_linestatus = 'O' AS is_active FROM lineitem""")
add_view("user_versions", history_sql("user_change_log", "user_id", ["user_type", "residence"]))
add_view("host_versions", history_sql("host_change_log", "host_id", ["is_verified", "is_active"]))


def user_versions(cat):
    return history.scd2_history(
        cat.source("user_changes"), "user_id", "changed_at", ["user_type", "residence"],
        [F.desc("change_id"), F.desc("user_type"), F.desc("residence")])


def host_versions(cat):
    return history.scd2_history(
        cat.source("host_changes"), "host_id", "changed_at", ["is_verified", "is_active"],
        [F.desc("change_id"), F.desc("is_verified"), F.desc("is_active")])


def _late_changes(cat):
    """A history of a third of the change log, then the other changes in two batches, most of them late; the last batch twice."""
    log, args = cat.source("user_changes"), ("user_id", "changed_at", ["user_type", "residence"], "change_id")
    batch = lambda k: log.where(F.pmod("change_id", F.lit(3)) == k)
    # Versions end dealt by user, so they are written without a further shuffle.
    out = materialize(history.scd2_from_log(batch(1), *args), "late-changes", rebalance=False)
    for k in (2, 0, 0):
        out = materialize(history.scd2_insert(out, batch(k), *args), "late-changes", rebalance=False)
    return out.drop("decided", "repeats")


QUERIES["scd2_history"] = user_versions
QUERIES["scd2_late_changes"] = _late_changes
ORACLE["scd2_late_changes"] = with_views("SELECT * FROM user_versions")
ORACLE["scd2_history"] = with_views("SELECT * FROM user_versions")
QUERIES["scd2_history_hosts"] = host_versions
ORACLE["scd2_history_hosts"] = with_views("SELECT * FROM host_versions")


def _overlaps(cat):
    """Break every seventh key's history on purpose, then find the damage."""
    good = cat.store("user_versions", lambda: user_versions(cat))
    broken = good.withColumns(
        {
            "effective_to": F.when(F.col("user_id") % 7 == 0, F.date_add(F.col("effective_to"), 400)).otherwise(F.col("effective_to")),
            "is_current": F.col("is_current") | (F.col("user_id") % 11 == 0),
        }
    )
    return history.version_problems(broken, "user_id")


QUERIES["scd2_overlap_check"] = _overlaps
ORACLE["scd2_overlap_check"] = with_views("""SELECT user_id, 'overlap' AS problem, count(*) AS occurrences FROM (
        SELECT *, lead(effective_from) OVER (PARTITION BY user_id ORDER BY effective_from) AS nxt FROM user_versions)
        WHERE user_id % 7 = 0 AND nxt IS NOT NULL AND effective_to + 400 > nxt GROUP BY 1
    UNION ALL SELECT user_id, 'several_current', count(*) FROM user_versions WHERE user_id % 11 = 0 OR is_current GROUP BY 1 HAVING count(*) > 1""")

# --- dimensions and facts --------------------------------------------------------------------


def _dates(cat):
    """Calendar days with the bookings that check in on them."""
    booked = cat.table("fact_booking_daily").groupBy("check_in_date").agg(F.sum("booking_count").alias("bookings"))
    return cat.table("dim_date").join(booked, F.col("date") == F.col("check_in_date"), "left").select(
        "date", "year", "quarter", "month", "month_name", "week_of_year", "day_of_week", "day_of_week_name", "day_of_month",
        "day_of_year", "is_weekend", "is_holiday", F.coalesce("bookings", F.lit(0)).alias("bookings"))


QUERIES["dim_date"] = _dates
ORACLE["dim_date"] = with_views("SELECT date, " + ", ".join(f"{big(c)} AS {c}" for c in ("year", "quarter", "month", "week_of_year", "day_of_week", "day_of_month", "day_of_year"))
    + """, month_name, day_of_week_name, is_weekend, FALSE AS is_holiday, CAST(coalesce(n, 0) AS BIGINT) AS bookings
    FROM dim_date LEFT JOIN (SELECT check_in_date, sum(booking_count) AS n FROM fact_booking_daily GROUP BY 1) ON date = check_in_date""")

QUERIES["fact_booking_detail"] = lambda cat: keys.conform(cat.plan("fact_booking_detail"), gold.FACT_BOOKING_DETAIL)
ORACLE["fact_booking_detail"] = with_views(f"""SELECT booking_id, user_id, host_id, property_id, destination_id, check_in_date, check_out_date,
    {big('guests_count')} AS guests_count, {big('nights_booked')} AS nights_booked, {dbl('total_amount')} AS total_amount, {dbl('payment_amount')} AS payment_amount,
    payment_method, status, created_at, updated_at, {big('days_between_booking_and_checkin')} AS days_between_booking_and_checkin, is_cancelled, is_business_booking
    FROM fact_booking_detail""")
QUERIES["fact_booking_daily"] = lambda cat: keys.conform(cat.plan("fact_booking_daily"), gold.FACT_BOOKING_DAILY)
ORACLE["fact_booking_daily"] = with_views(f"""SELECT property_id, destination_id, check_in_date, booking_count, confirmed_booking_count, cancellation_count,
    {dbl('total_booking_value')} AS total_booking_value, {dbl('avg_booking_value')} AS avg_booking_value, total_guests,
    {dbl('avg_nights_booked')} AS avg_nights_booked, {dbl('payment_completion_rate')} AS payment_completion_rate FROM fact_booking_daily""")
QUERIES["fact_property_engagement"] = lambda cat: cat.plan("fact_property_engagement")
ORACLE["fact_property_engagement"] = with_views("""SELECT property_id, engagement_date, view_count, unique_user_views, click_count, search_count,
    CAST(conversion_rate AS DOUBLE) AS conversion_rate, CAST(avg_time_on_page AS DOUBLE) AS avg_time_on_page FROM fact_property_engagement""")
QUERIES["conversion_rate"] = lambda cat: cat.table("fact_property_engagement").where("conversion_rate > 0").select(
    "property_id", "engagement_date", "view_count", "conversion_rate")
ORACLE["conversion_rate"] = with_views("""SELECT e.property_id, engagement_date, view_count, CAST(conversion_rate AS DOUBLE) AS conversion_rate
    FROM fact_property_engagement e JOIN fact_booking_daily d ON d.property_id = e.property_id AND d.check_in_date = e.engagement_date WHERE view_count > 0""")
QUERIES["dim_weather_location"] = lambda cat: cat.plan("dim_weather_location")
ORACLE["dim_weather_location"] = with_views('SELECT md5("locationKey") AS location_key, * FROM src_locations')
QUERIES["fact_weather_daily"] = lambda cat: cat.plan("fact_weather_daily")
ORACLE["fact_weather_daily"] = with_views("""SELECT * EXCLUDE (t), md5("locationKey") AS location_key, 'C' AS "temperatureUnit" FROM fact_weather_daily""")

QUERIES["validate_grain"] = lambda cat: keys.grain_report(cat.silver("payments"), ["payment_id"]).withColumn("table_name", F.lit("payments")).unionByName(
    keys.grain_report(keys.validate_grain(cat.table("fact_booking_daily"), ["property_id", "check_in_date"]), ["property_id", "check_in_date"]).withColumn("table_name", F.lit("fact_booking_daily")))
ORACLE["validate_grain"] = with_views("""SELECT 'payments' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS duplicated_keys
    FROM (SELECT payment_id, count(*) AS n FROM s_payments GROUP BY 1)
    UNION ALL SELECT 'fact_booking_daily', count(*), count(*), 0 FROM fact_booking_daily""")
QUERIES["fk_check"] = lambda cat: keys.orphans([
    keys.Related(cat.table("fact_booking_detail"), {"user": ("user_id", "user"), "property": ("property_id", "property")}),
    keys.Related(cat.table("fact_property_engagement"), {"engaged_property": ("property_id", "property")}),
    keys.Related(current(cat.table("dim_user")), key=("user_id", "user")), keys.Related(current(cat.table("dim_property")), key=("property_id", "property")),
]).withColumnRenamed("check", "reference")
ORACLE["fk_check"] = with_views("""SELECT 'user' AS reference, count(*) AS orphan_rows, count(DISTINCT user_id) AS orphan_keys FROM fact_booking_detail ANTI JOIN dim_user USING (user_id)
    UNION ALL SELECT 'property', count(*), count(DISTINCT property_id) FROM fact_booking_detail ANTI JOIN dim_property USING (property_id)
    UNION ALL SELECT 'engaged_property', count(*), count(DISTINCT property_id) FROM fact_property_engagement ANTI JOIN dim_property USING (property_id)""")


# --- joins and ordered operators ----------------------------------------------------------------

def _asof(cat):
    """Type of each user at the time of each booking."""
    left = cat.table("fact_booking_detail").select("booking_id", "user_id", "created_at")
    right = keys.dedup_latest(cat.source("user_changes"), ["user_id", "changed_at"], [F.desc("change_id")])
    return ordered.asof_join(left, right, ["user_id"], "created_at", "changed_at", ["user_type", "residence"])


QUERIES["asof_join"] = _asof
ORACLE["asof_join"] = with_views("""SELECT b.booking_id, b.user_id, b.created_at, c.changed_at, c.user_type, c.residence FROM fact_booking_detail b ASOF LEFT JOIN
    (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, changed_at ORDER BY change_id DESC) AS rn FROM user_change_log) WHERE rn = 1) c
    ON b.user_id = c.user_id AND b.created_at >= c.changed_at""")
QUERIES["exact_percentile"] = lambda cat: ordered.exact_quantiles(
    cat.table("fact_booking_detail").groupBy("user_id").agg(F.sum("total_amount").alias("spend")), "spend", {"p50": 0.5, "p90": 0.9, "p95": 0.95})
ORACLE["exact_percentile"] = with_views("""SELECT quantile_cont(s, 0.5) AS p50, quantile_cont(s, 0.9) AS p90, quantile_cont(s, 0.95) AS p95
    FROM (SELECT CAST(sum(total_amount) AS DOUBLE) AS s FROM fact_booking_detail GROUP BY user_id)""")
QUERIES["global_row_number"] = lambda cat: ordered.global_row_number(
    cat.table("fact_booking_detail").select("total_amount", "booking_id"), ["total_amount", "booking_id"])
ORACLE["global_row_number"] = with_views("SELECT CAST(total_amount AS DOUBLE) AS total_amount, booking_id, row_number() OVER (ORDER BY total_amount, booking_id) AS row_number FROM fact_booking_detail")


def _synthetic(cat):
    """Seeded facts, as many as there are bookings, keyed into the real dimensions."""
    from innsight.sources.synthetic import synthetic_bookings

    facts = synthetic_bookings(cat.table("fact_booking_detail"), current(cat.table("dim_property")), current(cat.table("dim_user")), seed=42)
    orphans = keys.orphan_count(facts, cat.table("dim_property"), "property_id").unionByName(keys.orphan_count(facts, cat.table("dim_user"), "user_id"))
    return facts.agg(F.count(F.lit(1)).alias("made_rows"), F.countDistinct("booking_id").alias("made_keys"), F.count_if(F.col("check_out_date") <= F.col("check_in_date")).alias("bad_stays")).withColumn(
        "orphan_rows", orphans.agg(F.sum("orphan_rows")).scalar())


QUERIES["synthetic_facts"] = _synthetic
ORACLE["synthetic_facts"] = with_views("SELECT count(*) AS made_rows, count(*) AS made_keys, 0 AS bad_stays, 0 AS orphan_rows FROM fact_booking_detail")

ORACLE["slice_monthly_revenue"] = with_views(f"""SELECT period_start, strftime(period_start, '%B %Y') AS period_name, {dbl('v')} AS total_revenue, {big('n')} AS booking_count,
    CAST(v AS DOUBLE) / n AS avg_booking_value, {big('cf')} AS confirmed_bookings, {big('cc')} AS cancellation_count, CAST(cc AS DOUBLE) / n * 100 AS cancellation_rate,
    u AS unique_properties, {big('g')} AS unique_guests FROM (SELECT CAST(date_trunc('month', check_in_date) AS DATE) AS period_start, sum(total_booking_value) AS v,
    sum(booking_count) AS n, sum(confirmed_booking_count) AS cf, sum(cancellation_count) AS cc, count(DISTINCT property_id) AS u, sum(total_guests) AS g
    FROM fact_booking_daily GROUP BY 1)""")
