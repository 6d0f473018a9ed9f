"""Metric views: every dimension and measure at least once."""

from __future__ import annotations

from innsight.plans import metrics
from oracle.base import big, dbl, mean, ratio, with_views
from registry import reports  # noqa: F401 - shared views
from registry.common import AS_OF

QUERIES: dict = {}
ORACLE: dict = {}

ASOF = {"as_of": f"DATE'{AS_OF}'"}


def measures(view: metrics.MetricView) -> list[str]:
    return [m.name for m in view.measures]


# Parts of the DuckDB spelling: each base row carries its own rolled-up facts.
REV_FROM = "fact_booking_daily f LEFT JOIN dim_property p ON p.property_id = f.property_id LEFT JOIN dim_destination d ON d.destination_id = f.destination_id LEFT JOIN dim_date c ON c.date = f.check_in_date"
REV = f"""{dbl('sum(total_booking_value)')} AS total_revenue, {big('sum(booking_count)')} AS booking_count, {mean('avg_booking_value')} AS avg_booking_value, {big('sum(total_guests)')} AS total_guests,
    {mean('avg_nights_booked')} AS avg_nights, {big('sum(cancellation_count)')} AS cancellation_count, {big('sum(confirmed_booking_count)')} AS confirmed_count,
    {ratio('sum(cancellation_count)', 'sum(booking_count)')} * 100 AS cancellation_rate, {mean('payment_completion_rate')} AS payment_rate, count(DISTINCT f.property_id) AS property_count"""
ENG_FROM = "fact_property_engagement e LEFT JOIN dim_property p ON p.property_id = e.property_id LEFT JOIN dim_date c ON c.date = e.engagement_date"
ENG = f"""{big('sum(view_count)')} AS total_views, {big('sum(unique_user_views)')} AS unique_viewers, {big('sum(click_count)')} AS total_clicks, {big('sum(search_count)')} AS search_appearances,
    {mean('conversion_rate')} AS avg_conversion_rate, {ratio('sum(click_count)', 'sum(view_count)')} * 100 AS click_through_rate, {mean('avg_time_on_page')} AS avg_time_on_page"""
PROP_FROM = """dim_property p LEFT JOIN dim_destination d ON d.destination_id = p.destination_id LEFT JOIN dim_host h ON h.host_id = p.host_id
    LEFT JOIN (SELECT property_id, sum(total_booking_value) AS v, sum(booking_count) AS n FROM fact_booking_daily GROUP BY 1) f ON f.property_id = p.property_id"""
PROP = f"""count(*) AS property_count, {mean('base_price')} AS avg_base_price, {big('sum(max_guests)')} AS total_capacity, {mean('bedrooms')} AS avg_bedrooms, {dbl('sum(v)')} AS total_revenue,
    {big('sum(n)')} AS booking_count, {ratio('sum(v)', 'count(*)')} AS revenue_per_property, {ratio('sum(n)', 'count(*)')} AS bookings_per_property"""
HOST_FROM = """dim_host h LEFT JOIN (SELECT host_id, count(*) AS props, sum(v) AS v, sum(n) AS n FROM dim_property LEFT JOIN
    (SELECT property_id, sum(total_amount) AS v, count(*) AS n FROM fact_booking_detail GROUP BY 1) USING (property_id) GROUP BY 1) f ON f.host_id = h.host_id"""
HOST = f"""count(*) AS host_count, count(*) FILTER (is_verified) AS verified_count, {mean('rating')} AS avg_rating, {big('coalesce(sum(props), 0)')} AS property_count, {dbl('sum(v)')} AS total_revenue,
    {big('coalesce(sum(n), 0)')} AS booking_count, {ratio('sum(v)', 'count(*)')} AS revenue_per_host, {ratio('count(*) FILTER (is_verified)', 'count(*)')} * 100 AS verification_rate"""
CUST_FROM = "dim_user u LEFT JOIN (SELECT user_id, sum(total_amount) AS v, count(*) AS n FROM fact_booking_detail GROUP BY 1) f ON f.user_id = u.user_id"
CUST = f"""count(*) AS customer_count, count(*) FILTER (is_business) AS business_count, {big('coalesce(sum(n), 0)')} AS booking_count, {dbl('sum(v)')} AS total_spend, {ratio('sum(v)', 'sum(n)')} AS avg_booking_value,
    {ratio('coalesce(sum(n), 0)', 'count(*)')} AS bookings_per_customer, {ratio('sum(v)', 'count(*)')} AS spend_per_customer, {ratio('count(*) FILTER (is_business)', 'count(*)')} * 100 AS business_rate"""


def add(name, view, dims, sql_dims, sql_measures, sql_from, **kw):
    where, having, tail = kw.pop("sql_where", ""), kw.pop("sql_having", ""), kw.pop("sql_tail", "")
    QUERIES[name] = lambda c: view.query(c.table, dims, measures(view), params=ASOF, **kw)
    group = ", ".join(e for _, e in sql_dims)
    head = "".join(f"{e} AS {a}, " for a, e in sql_dims)
    ORACLE[name] = with_views(f"SELECT {head}{sql_measures} FROM {sql_from} {where} " + (f"GROUP BY {group} " if group else "") + having + tail)


add("mv_revenue", metrics.REVENUE, ["destination", "country"], [("destination", "d.destination"), ("country", "d.country")], REV, REV_FROM)
add("mv_revenue_by_month", metrics.REVENUE, ["year", "month_name", "property_type"],
    [("year", big("c.year")), ("month_name", "c.month_name"), ("property_type", "p.property_type")], REV, REV_FROM,
    where="year BETWEEN 1996 AND 1999", sql_where="WHERE c.year BETWEEN 1996 AND 1999", having="booking_count > 5", sql_having="HAVING sum(booking_count) > 5")
add("mv_revenue_by_property", metrics.REVENUE, ["property_id", "property_title", "check_in_date"],
    [("property_id", "f.property_id"), ("property_title", "p.title"), ("check_in_date", "f.check_in_date")], REV, REV_FROM,
    order_by=["-total_revenue", "property_id", "check_in_date"], limit=50, sql_tail=" ORDER BY sum(total_booking_value) DESC, f.property_id, f.check_in_date LIMIT 50")
add("mv_engagement", metrics.ENGAGEMENT, ["engagement_date", "property_type", "month_name", "year"],
    [("engagement_date", "e.engagement_date"), ("property_type", "p.property_type"), ("month_name", "c.month_name"), ("year", big("c.year"))], ENG, ENG_FROM)
add("mv_engagement_by_property", metrics.ENGAGEMENT, ["property_id", "property_title", "destination_id"],
    [("property_id", "e.property_id"), ("property_title", "p.title"), ("destination_id", "p.destination_id")], ENG, ENG_FROM)
add("mv_property", metrics.PROPERTY, ["property_type", "country", "is_verified_host"],
    [("property_type", "p.property_type"), ("country", "d.country"), ("is_verified_host", "h.is_verified")], PROP, PROP_FROM)
add("mv_property_detail", metrics.PROPERTY, ["property_id", "property_title", "base_price", "bedrooms", "max_guests", "destination", "host_name"],
    [("property_id", "p.property_id"), ("property_title", "p.title"), ("base_price", dbl("p.base_price")), ("bedrooms", big("p.bedrooms")), ("max_guests", big("p.max_guests")),
     ("destination", "d.destination"), ("host_name", "h.name")], PROP, PROP_FROM)
add("mv_host", metrics.HOST, ["country", "is_verified", "is_active"], [("country", "h.country"), ("is_verified", "h.is_verified"), ("is_active", "h.is_active")], HOST, HOST_FROM)
add("mv_host_detail", metrics.HOST, ["host_id", "host_name", "rating", "joined_at", "host_since_days"],
    [("host_id", "h.host_id"), ("host_name", "h.name"), ("rating", "h.rating"), ("joined_at", "h.joined_at"), ("host_since_days", f"DATE '{AS_OF}' - h.joined_at")], HOST, HOST_FROM)
add("mv_customer", metrics.CUSTOMER, ["country", "user_type", "is_business", "is_current"],
    [("country", "u.country"), ("user_type", "u.user_type"), ("is_business", "u.is_business"), ("is_current", "u.is_current")], CUST, CUST_FROM)
add("mv_customer_detail", metrics.CUSTOMER, ["user_id", "created_at", "customer_tenure_days"],
    [("user_id", "u.user_id"), ("created_at", "u.created_at"), ("customer_tenure_days", f"DATE '{AS_OF}' - u.created_at")], CUST, CUST_FROM)

# Cohorts are taken at an earlier date so that several buckets fill.
COHORT_DAY = "1994-12-01"
_BUCKET = "CASE WHEN {d} < 30 THEN '0-30 days' WHEN {d} < 90 THEN '30-90 days' WHEN {d} < 180 THEN '90-180 days' WHEN {d} < 365 THEN '180-365 days' ELSE '1+ years' END"
QUERIES["mv_tenure_cohort"] = lambda c: metrics.tenure_cohort(metrics.CUSTOMER, c.table, COHORT_DAY, measures(metrics.CUSTOMER))
ORACLE["mv_tenure_cohort"] = with_views(f"SELECT {_BUCKET.format(d=f'''(DATE '{COHORT_DAY}' - u.created_at)''')} AS tenure_bucket, {CUST} FROM {CUST_FROM} GROUP BY 1")
QUERIES["mv_tenure_cohort_hosts"] = lambda c: metrics.tenure_cohort(metrics.HOST, c.table, COHORT_DAY, measures(metrics.HOST))
ORACLE["mv_tenure_cohort_hosts"] = with_views(f"SELECT {_BUCKET.format(d=f'''(DATE '{COHORT_DAY}' - h.joined_at)''')} AS tenure_bucket, {HOST} FROM {HOST_FROM} GROUP BY 1")

QUERIES["mv_cross"] = lambda c: metrics.hot_destinations(c.table, 0.5)
ORACLE["mv_cross"] = with_views(f"""SELECT destination, total_views, total_revenue FROM (SELECT destination_id, sum(view_count) AS v, {big('sum(view_count)')} AS total_views
    FROM fact_property_engagement LEFT JOIN dim_property USING (property_id) GROUP BY 1) JOIN dim_destination USING (destination_id) JOIN
    (SELECT destination, {dbl('sum(total_booking_value)')} AS total_revenue FROM fact_booking_daily LEFT JOIN dim_destination USING (destination_id) GROUP BY 1) USING (destination)
    WHERE total_views >= (SELECT quantile_disc(v, 0.5) FROM (SELECT sum(view_count) AS v FROM fact_property_engagement LEFT JOIN dim_property USING (property_id) GROUP BY destination_id))
    AND total_revenue >= (SELECT quantile_disc(v, 0.5) FROM (SELECT {dbl('sum(total_booking_value)')} AS v FROM fact_booking_daily LEFT JOIN dim_destination USING (destination_id) GROUP BY destination))
    ORDER BY total_views DESC, total_revenue DESC""")
QUERIES["mv_cross_first"] = lambda c: metrics.hot_destinations(c.table, 0.5, 2)
ORACLE["mv_cross_first"] = f"{ORACLE['mv_cross']} LIMIT 2"
QUERIES["mv_overview"] = lambda c: metrics.overview(c.table)
ORACLE["mv_overview"] = with_views(f"""SELECT * FROM (SELECT {dbl('sum(total_booking_value)')} AS total_revenue, {big('sum(booking_count)')} AS total_bookings, {mean('avg_booking_value')} AS avg_booking FROM fact_booking_daily),
    (SELECT count(*) AS total_properties FROM dim_property), (SELECT count(*) AS total_hosts, {ratio('count(*) FILTER (is_verified)', 'count(*)')} * 100 AS verification_rate FROM dim_host),
    (SELECT count(*) AS total_customers, CAST((SELECT sum(total_amount) FROM fact_booking_detail SEMI JOIN dim_user USING (user_id)) AS DOUBLE) / count(*) AS avg_ltv FROM dim_user)""")
