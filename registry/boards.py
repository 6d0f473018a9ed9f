"""The 44 dashboard datasets."""

from __future__ import annotations

from innsight.plans import dashboards
from oracle.base import big, dbl, mean, ratio, with_views
from registry import reports  # noqa: F401 - shared views
from registry.common import END, START

QUERIES: dict = {}
ORACLE: dict = {}

# No listing of the test tables is seen 50 times.
OPTIONS = {"low_conversion_properties": {"min_views": 1}}
FIRST = {"customer_customers_by_country": 15, "property_price_vs_performance": 100, "revenue_booking_detail_table": 100}

for _board, _sets in dashboards.DATASETS.items():
    for _name, _build in _sets.items():
        QUERIES[f"dash_{_board}_{_name}"] = lambda c, b=_build, o=OPTIONS.get(_name, {}): b(c.table, START, END, **o)

SEG = "CASE WHEN u.is_business THEN 'Business' ELSE 'Leisure' END"
BIZ = "detail f JOIN dim_user u ON u.user_id = f.user_id"
PLACED = "engaged e JOIN dim_property p USING (property_id) JOIN dim_destination d USING (destination_id)"
CONV = mean("conversion_rate")


def pct(cond: str) -> str:
    return f"{ratio(f'count(*) FILTER ({cond})', 'count(*)')} * 100"


def every(column: str, values: str) -> str:
    return f"SELECT 'All' AS {column} UNION ALL {values}"


HOSTS = "hosted h"  # hosts with totals over their listings
SQL = {
    "customer_customer_kpis": f"SELECT count(*) AS total_customers, {pct('is_business')} AS business_pct FROM dim_user",
    "customer_customer_segments": f"""SELECT CASE WHEN bookings >= 5 THEN 'VIP (5+ bookings)' WHEN bookings >= 3 THEN 'Loyal (3-4 bookings)' WHEN bookings >= 2 THEN 'Returning (2 bookings)' ELSE 'New (1 booking)' END AS segment,
        count(*) AS customer_count, {dbl('sum(revenue)')} AS total_revenue, {ratio('sum(revenue)', 'count(*)')} AS avg_spend_per_customer FROM per_user GROUP BY 1""",
    "customer_business_vs_leisure": f"SELECT {SEG} AS segment, count(*) AS bookings, {dbl('sum(total_amount)')} AS revenue, {mean('total_amount')} AS avg_booking_value, {mean('nights_booked')} AS avg_stay_length FROM {BIZ} GROUP BY 1",
    "customer_customers_by_country": f"SELECT country, count(*) AS customer_count, {big('coalesce(sum(bookings), 0)')} AS bookings, {dbl('sum(revenue)')} AS revenue FROM booked_users GROUP BY 1 ORDER BY 4 DESC NULLS LAST, 1",
    "customer_booking_frequency_distribution": """SELECT CASE WHEN bookings = 1 THEN '1 booking' WHEN bookings = 2 THEN '2 bookings' WHEN bookings <= 4 THEN '3-4 bookings' WHEN bookings <= 9 THEN '5-9 bookings' ELSE '10+ bookings' END AS frequency_bucket,
        count(*) AS customer_count FROM per_user GROUP BY 1""",
    "customer_lead_time_by_segment": f"SELECT {SEG} AS segment, {mean('days_between_booking_and_checkin')} AS avg_lead_time, {big('quantile_disc(days_between_booking_and_checkin, 0.5)')} AS median_lead_time FROM {BIZ} GROUP BY 1",
    "customer_top_customers_by_spend": f"""SELECT u.user_id, name, country, is_business, count(*) AS booking_count, {dbl('sum(total_amount)')} AS total_spend, {mean('total_amount')} AS avg_booking_value FROM {BIZ}
        GROUP BY 1, 2, 3, 4 ORDER BY 6 DESC, 1 LIMIT 20""",
    "customer_new_vs_returning": """SELECT CAST(date_trunc('month', check_in_date) AS DATE) AS month, count(DISTINCT CASE WHEN first_day = check_in_date THEN user_id END) AS new_customers,
        count(DISTINCT CASE WHEN first_day < check_in_date THEN user_id END) AS returning_customers FROM detail JOIN (SELECT user_id, min(check_in_date) AS first_day FROM fact_booking_detail GROUP BY 1) USING (user_id) GROUP BY 1""",
    "customer_destination_preferences_by_segment": f"SELECT {SEG} AS segment, destination, count(*) AS bookings, {dbl('sum(total_amount)')} AS revenue FROM {BIZ} JOIN dim_destination USING (destination_id) GROUP BY 1, 2 ORDER BY 1, 4 DESC, 2",
    "customer_user_type_filter_values": every("user_type", f"SELECT DISTINCT {SEG} FROM dim_user u"),
    "engagement_engagement_kpis": f"SELECT {big('sum(view_count)')} AS total_views, {big('sum(unique_user_views)')} AS unique_users, {big('sum(click_count)')} AS total_clicks, {CONV} AS avg_conversion_rate FROM engaged",
    "engagement_conversion_funnel": f"""SELECT 'Views' AS stage, 1::BIGINT AS stage_order, {big('sum(view_count)')} AS count FROM engaged UNION ALL SELECT 'Clicks', 2, {big('sum(click_count)')} FROM engaged
        UNION ALL SELECT 'Searches', 3, {big('sum(search_count)')} FROM engaged""",
    "engagement_engagement_trend": f"SELECT engagement_date, {big('sum(view_count)')} AS views, {big('sum(click_count)')} AS clicks, {CONV} AS conversion_rate FROM engaged GROUP BY 1",
    "engagement_conversion_by_property_type": f"SELECT property_type, {big('sum(view_count)')} AS views, {big('sum(click_count)')} AS clicks, {CONV} AS conversion_rate FROM engaged JOIN dim_property USING (property_id) GROUP BY 1",
    "engagement_top_engaged_properties": f"""SELECT title AS property_title, destination, {big('sum(view_count)')} AS total_views, {big('sum(click_count)')} AS total_clicks, {CONV} AS avg_conversion_rate, {mean('avg_time_on_page')} AS avg_time_on_page
        FROM {PLACED} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
    "engagement_low_conversion_properties": f"""SELECT title AS property_title, destination, {dbl('base_price')} AS base_price, {big('sum(view_count)')} AS total_views, {CONV} AS avg_conversion_rate FROM {PLACED} GROUP BY 1, 2, base_price
        HAVING sum(view_count) >= 1 ORDER BY 5 ASC NULLS FIRST, 1, 2, base_price""",
    "engagement_engagement_by_destination": f"SELECT destination, country, {big('sum(view_count)')} AS total_views, {big('sum(click_count)')} AS total_clicks, {CONV} AS avg_conversion_rate FROM {PLACED} GROUP BY 1, 2 ORDER BY 3 DESC, 1",
    "engagement_property_type_filter_values": every("property_type", "SELECT DISTINCT property_type FROM dim_property"),
    "host_host_kpis": f"SELECT count(*) AS total_hosts, {pct('is_verified')} AS verified_pct, {mean('rating')} AS avg_rating, {pct('is_active')} AS active_pct FROM dim_host",
    "host_host_rating_distribution": "SELECT floor(rating * 2) / 2 AS rating_bucket, count(*) AS host_count FROM dim_host WHERE is_active AND rating IS NOT NULL GROUP BY 1",
    "host_verification_impact": f"SELECT CASE WHEN is_verified THEN 'Verified' ELSE 'Not Verified' END AS status, count(*) AS host_count, {mean('rating')} AS avg_rating, coalesce({ratio('sum(revenue)', 'count(*)')}, 0) AS revenue_per_host FROM {HOSTS} GROUP BY 1",
    "host_top_hosts_by_revenue": f"""SELECT host_id, name, country, rating, is_verified, property_count, {big('bookings')} AS booking_count, {dbl('revenue')} AS total_revenue FROM {HOSTS} WHERE property_count > 0
        ORDER BY revenue DESC NULLS LAST, host_id LIMIT 20""",
    "host_top_hosts_by_rating": f"""SELECT host_id, name, country, rating, is_verified, property_count, {big('bookings')} AS booking_count FROM {HOSTS} WHERE property_count > 0 AND is_active AND rating IS NOT NULL AND bookings >= 5
        ORDER BY rating DESC, host_id LIMIT 20""",
    "host_hosts_by_country": f"SELECT country, count(*) AS host_count, {mean('rating')} AS avg_rating, {pct('is_verified')} AS verified_pct FROM dim_host WHERE is_active GROUP BY 1 ORDER BY 2 DESC, 1",
    "host_multi_property_hosts": f"SELECT host_id, name, country, rating, is_verified, property_count, coalesce({dbl('revenue')}, 0) AS total_revenue FROM {HOSTS} WHERE property_count > 1 ORDER BY property_count DESC, host_id",
    "host_country_filter_values": every("country", "SELECT DISTINCT country FROM dim_host"),
    "property_portfolio_kpis": f"SELECT count(*) AS property_count, {big('sum(max_guests)')} AS total_capacity, {mean('base_price')} AS avg_price FROM dim_property",
    "property_properties_by_destination": f"SELECT destination, country, count(*) AS property_count, {mean('base_price')} AS avg_price FROM dim_property JOIN dim_destination USING (destination_id) GROUP BY 1, 2 ORDER BY 3 DESC, 1",
    "property_price_distribution": """SELECT CASE WHEN base_price < 100 THEN '$0-100' WHEN base_price < 200 THEN '$100-200' WHEN base_price < 300 THEN '$200-300' WHEN base_price < 500 THEN '$300-500' ELSE '$500+' END AS price_bucket,
        count(*) AS property_count FROM dim_property GROUP BY 1""",
    "property_property_type_distribution": f"SELECT property_type, count(*) AS property_count, {mean('base_price')} AS avg_price, {mean('bedrooms')} AS avg_bedrooms FROM dim_property GROUP BY 1",
    "property_top_performing_properties": f"""SELECT property_id, title, destination, property_type, {dbl('base_price')} AS base_price, bookings AS booking_count, {dbl('revenue')} AS total_revenue FROM listed JOIN dim_destination USING (destination_id)
        ORDER BY revenue DESC NULLS LAST, property_id LIMIT 20""",
    "property_bottom_performing_properties": f"""SELECT property_id, title, destination, property_type, {dbl('base_price')} AS base_price, bookings AS booking_count, coalesce({dbl('revenue')}, 0) AS total_revenue FROM listed
        JOIN dim_destination USING (destination_id) WHERE bookings <= 5 ORDER BY coalesce(revenue, 0), property_id LIMIT 20""",
    "property_price_vs_performance": f"SELECT property_id, title, {dbl('base_price')} AS base_price, property_type, coalesce({dbl('revenue')}, 0) AS total_revenue, bookings AS booking_count FROM listed ORDER BY property_id",
    "property_property_amenities_analysis": f"SELECT {big('bedrooms')} AS bedrooms, {big('bathrooms')} AS bathrooms, count(*) AS property_count, {mean('base_price')} AS avg_price, {mean('max_guests')} AS avg_capacity FROM dim_property GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2",
    "property_destination_filter_values": every("destination", "SELECT DISTINCT destination FROM dim_destination"),
    "revenue_executive_kpis": f"SELECT {dbl('sum(total_amount)')} AS total_revenue, count(*) AS booking_count, {mean('total_amount')} AS avg_booking_value, {pct('is_cancelled')} AS cancellation_rate FROM detail",
    "revenue_revenue_trend_monthly": f"SELECT CAST(date_trunc('month', check_in_date) AS DATE) AS month, {dbl('sum(total_amount)')} AS revenue, count(*) AS bookings FROM detail GROUP BY 1",
    "revenue_revenue_by_destination": f"SELECT destination, country, {dbl('sum(total_amount)')} AS revenue, count(*) AS bookings FROM detail JOIN dim_destination USING (destination_id) GROUP BY 1, 2 ORDER BY 3 DESC, 1",
    "revenue_booking_funnel": "SELECT count(*) AS confirmed_bookings, count(*) FILTER (status = 'cancelled') AS cancelled, count(*) FILTER (status = 'completed') AS completed FROM detail",
    "revenue_cancellation_trend": f"SELECT CAST(date_trunc('month', check_in_date) AS DATE) AS month, {pct('is_cancelled')} AS cancellation_rate FROM detail GROUP BY 1",
    "revenue_revenue_by_property_type": f"SELECT property_type, {dbl('sum(total_amount)')} AS revenue, count(*) AS bookings, {mean('total_amount')} AS avg_booking_value FROM detail JOIN dim_property USING (property_id) GROUP BY 1",
    "revenue_lead_time_distribution": f"""SELECT CASE WHEN days_between_booking_and_checkin < 7 THEN '0-7 days' WHEN days_between_booking_and_checkin < 30 THEN '7-30 days' WHEN days_between_booking_and_checkin < 90 THEN '30-90 days' ELSE '90+ days' END
        AS lead_time_bucket, count(*) AS booking_count, {dbl('sum(total_amount)')} AS revenue FROM detail GROUP BY 1""",
    "revenue_booking_detail_table": f"""SELECT booking_id, u.name AS customer_name, p.title AS property_title, destination, check_in_date, {big('nights_booked')} AS nights_booked, {dbl('total_amount')} AS total_amount, status
        FROM detail f JOIN dim_user u ON u.user_id = f.user_id JOIN dim_property p ON p.property_id = f.property_id JOIN dim_destination d ON d.destination_id = f.destination_id ORDER BY check_in_date DESC, booking_id""",
    "revenue_destination_filter_values": every("destination", "SELECT DISTINCT destination FROM dim_destination"),
}
ORACLE.update({f"dash_{name}": with_views(sql) for name, sql in SQL.items()})
for _name, _n in FIRST.items():
    _board, _set = _name.split("_", 1)
    QUERIES[f"dash_{_name}_first"] = lambda c, b=dashboards.DATASETS[_board][_set], n=_n: b(c.table, START, END, limit=n)
    ORACLE[f"dash_{_name}_first"] = with_views(f"{SQL[_name]} LIMIT {_n}")
