"""Reports the documents promise beyond the coded ones."""

from __future__ import annotations

from innsight.functions import traffic
from oracle.base import big, dbl, with_views
from registry import reports  # noqa: F401 - shared views
from registry.common import END, START

QUERIES: dict = {}
ORACLE: dict = {}


def _traffic_sql(name: str, view_key: str, click_key: str) -> str:
    return with_views(f"""SELECT coalesce(v.k, c.k) AS {name}, coalesce(total_views, 0) AS total_views, coalesce(unique_viewers, 0) AS unique_viewers, coalesce(total_clicks, 0) AS total_clicks,
        coalesce(total_searches, 0) AS total_searches, CAST(coalesce(total_clicks, 0) AS DOUBLE) / nullif(coalesce(total_views, 0), 0) * 100 AS click_through_rate FROM
        (SELECT {view_key} AS k, count(*) AS total_views, count(DISTINCT user_id) AS unique_viewers FROM s_page_views GROUP BY 1) v FULL JOIN
        (SELECT {click_key} AS k, count(*) FILTER (event = 'click') AS total_clicks, count(*) FILTER (event = 'search') AS total_searches FROM s_clickstream GROUP BY 1) c ON v.k = c.k""")


QUERIES["get_traffic_by_referrer"] = lambda c: traffic.get_traffic_by_referrer(c.silver("page_views"), c.silver("clickstream"), START, END)
ORACLE["get_traffic_by_referrer"] = _traffic_sql("referrer", "referrer", "referrer")
QUERIES["get_device_engagement"] = lambda c: traffic.get_device_engagement(c.silver("page_views"), c.silver("clickstream"), START, END)
ORACLE["get_device_engagement"] = _traffic_sql("device", "device_type", "device")

# Halves of the whole booking history: 1995-01-01 .. 1998-05-02 against 1998-05-03 .. 2001-09-01.
_FIRST, _LAST = "1998-05-03", "2001-09-01"
QUERIES["kpi_vs_previous_period"] = lambda c: traffic.kpi_vs_previous_period(c.table("fact_booking_detail"), _FIRST, _LAST)
_PERIODS = f"""SELECT sum(total_amount) FILTER (check_in_date >= DATE '{_FIRST}') AS r1, sum(total_amount) FILTER (check_in_date < DATE '{_FIRST}') AS r0, count(*) FILTER (check_in_date >= DATE '{_FIRST}') AS n1,
    count(*) FILTER (check_in_date < DATE '{_FIRST}') AS n0, count(*) FILTER (check_in_date >= DATE '{_FIRST}' AND is_cancelled) AS c1, count(*) FILTER (check_in_date < DATE '{_FIRST}' AND is_cancelled) AS c0
    FROM fact_booking_detail WHERE check_in_date BETWEEN DATE '{_FIRST}' - CAST(DATE '{_LAST}' - DATE '{_FIRST}' + 1 AS INTEGER) AND DATE '{_LAST}'"""
ORACLE["kpi_vs_previous_period"] = with_views(f"""SELECT kpi, a AS current_value, b AS previous_value, (a - b) / nullif(b, 0) * 100 AS pct_change FROM (SELECT unnest(['revenue', 'bookings', 'avg_booking_value', 'cancellation_rate']) AS kpi,
    unnest([{dbl('r1')}, {dbl('n1')}, {dbl('r1')} / n1, {dbl('c1')} / n1 * 100]) AS a, unnest([{dbl('r0')}, {dbl('n0')}, {dbl('r0')} / n0, {dbl('c0')} / n0 * 100]) AS b FROM ({_PERIODS}))""")
QUERIES["revenue_yoy"] = lambda c: traffic.revenue_yoy(c.table("fact_booking_daily"), START, END)
ORACLE["revenue_yoy"] = with_views(f"""SELECT a.p AS period_start, a.r AS revenue, a.n AS bookings, b.r AS revenue_last_year, b.n AS bookings_last_year, (a.r - b.r) / nullif(b.r, 0) * 100 AS revenue_yoy_pct FROM
    (SELECT CAST(date_trunc('month', check_in_date) AS DATE) AS p, {dbl('sum(total_booking_value)')} AS r, {big('sum(booking_count)')} AS n FROM fact_booking_daily GROUP BY 1) a LEFT JOIN
    (SELECT CAST(date_trunc('month', check_in_date) + INTERVAL 12 MONTHS AS DATE) AS p, {dbl('sum(total_booking_value)')} AS r, {big('sum(booking_count)')} AS n FROM fact_booking_daily GROUP BY 1) b ON a.p = b.p""")
