"""The parameterised report functions."""

from __future__ import annotations

from innsight.functions import customer, engagement, host, property, revenue
from oracle.base import add_view, big, dbl, mean, ratio, with_views
from registry.common import AS_OF, END, START

QUERIES: dict = {}
ORACLE: dict = {}

SPAN = f"(DATE '{END}' - DATE '{START}')"
RANGE = f"BETWEEN DATE '{START}' AND DATE '{END}'"
PLACE = "destination || ', ' || state_or_province || ', ' || country"


def t(cat, *names):
    return [cat.table(n) for n in names]


add_view("daily", f"SELECT * FROM fact_booking_daily WHERE check_in_date {RANGE}")
add_view("detail", f"SELECT * FROM fact_booking_detail WHERE check_in_date {RANGE}")
add_view("engaged", f"SELECT * FROM fact_property_engagement WHERE engagement_date {RANGE}")
add_view("places", f"SELECT destination_id, {PLACE} AS place, destination, state_or_province, country FROM dim_destination")
add_view("per_property", """SELECT property_id, count(*) AS bookings, sum(total_amount) AS revenue, count(*) FILTER (is_cancelled) AS cancelled,
    sum(nights_booked) AS nights FROM detail GROUP BY 1""")
add_view("per_user", """SELECT user_id, count(*) AS bookings, sum(total_amount) AS revenue, count(*) FILTER (is_cancelled) AS cancelled,
    sum(nights_booked) AS nights FROM detail GROUP BY 1""")
add_view("eng", """SELECT property_id, sum(view_count) AS views, sum(unique_user_views) AS viewers, sum(click_count) AS clicks, sum(search_count) AS searches,
    sum(conversion_rate) AS cs, count(conversion_rate) AS cd, count(*) AS days FROM engaged GROUP BY 1""")
add_view("eng_booked", "SELECT property_id, sum(booking_count) AS booked FROM daily d SEMI JOIN engaged e ON d.property_id = e.property_id AND d.check_in_date = e.engagement_date GROUP BY 1")
add_view("listed", "SELECT p.*, coalesce(b.bookings, 0) AS bookings, b.revenue, b.cancelled, b.nights FROM dim_property p LEFT JOIN per_property b USING (property_id)")
add_view("hosted", """SELECT h.*, coalesce(n, 0) AS property_count, coalesce(b, 0) AS bookings, r AS revenue, coalesce(c, 0) AS cancelled FROM dim_host h LEFT JOIN
    (SELECT host_id, count(*) AS n, sum(bookings) AS b, sum(revenue) AS r, sum(cancelled) AS c FROM listed GROUP BY 1) USING (host_id)""")
add_view("booked_users", "SELECT u.*, coalesce(b.bookings, 0) AS bookings, b.revenue, coalesce(b.cancelled, 0) AS cancelled, b.nights FROM dim_user u LEFT JOIN per_user b USING (user_id)")


def ranked(inner: str, order: str, n: int | None = None) -> str:
    every = f"SELECT row_number() OVER (ORDER BY {order}) AS rank, * FROM ({inner})"
    return every if n is None else f"{every} QUALIFY rank <= {n}"


# --- revenue ------------------------------------------------------------------------------
def period_sql(grain: str, name: str) -> str:
    return with_views(f"""SELECT p AS period_start, {name} AS period_name, {dbl('v')} AS total_revenue, {big('n')} AS booking_count, {ratio('v', 'n')} AS avg_booking_value,
        {big('cf')} AS confirmed_bookings, {big('cc')} AS cancellation_count, {ratio('cc', 'n')} * 100 AS cancellation_rate, u AS unique_properties, {big('g')} AS unique_guests
        FROM (SELECT CAST(date_trunc('{grain}', check_in_date) AS DATE) AS p, sum(total_booking_value) AS v, sum(booking_count) AS n, sum(confirmed_booking_count) AS cf,
        sum(cancellation_count) AS cc, count(DISTINCT property_id) AS u, sum(total_guests) AS g FROM daily GROUP BY 1)""")


QUERIES["get_revenue_by_period"] = lambda c: revenue.get_revenue_by_period(*t(c, "fact_booking_daily"), START, END, "week")
ORACLE["get_revenue_by_period"] = period_sql("week", "'Week ' || weekofyear(p) || ' ' || year(p)")
for _grain, _name in (("day", "CAST(p AS VARCHAR)"), ("month", "strftime(p, '%B %Y')"), ("quarter", "'Q' || quarter(p) || ' ' || year(p)"), ("year", "CAST(year(p) AS VARCHAR)")):
    QUERIES[f"get_revenue_by_period_{_grain}"] = lambda c, g=_grain: revenue.get_revenue_by_period(*t(c, "fact_booking_daily"), START, END, g)
    ORACLE[f"get_revenue_by_period_{_grain}"] = period_sql(_grain, _name)

QUERIES["get_top_properties_by_revenue"] = lambda c: revenue.get_top_properties_by_revenue(
    *t(c, "fact_booking_daily", "dim_property", "dim_destination", "dim_host"), START, END, 10)
ORACLE["get_top_properties_by_revenue"] = with_views(f"""SELECT rank, r.property_id, p.title AS property_title, d.place AS destination, p.property_type, h.name AS host_name,
    {dbl('v')} AS total_revenue, {big('n')} AS booking_count, {ratio('v', 'n')} AS avg_revenue_per_booking, {dbl('nights')} AS total_nights, {ratio('n', SPAN)} * 100 AS avg_occupancy_rate
    FROM ({ranked('SELECT property_id, max(destination_id) AS dest, sum(total_booking_value) AS v, sum(booking_count) AS n, sum(avg_nights_booked * booking_count) AS nights FROM daily GROUP BY 1', 'v DESC, property_id', 10)}) r
    LEFT JOIN dim_property p USING (property_id) LEFT JOIN places d ON d.destination_id = r.dest LEFT JOIN dim_host h ON h.host_id = p.host_id""")
QUERIES["get_revenue_by_destination"] = lambda c: revenue.get_revenue_by_destination(*t(c, "fact_booking_daily", "dim_destination"), START, END)
ORACLE["get_revenue_by_destination"] = with_views(f"""SELECT rank, destination_id, destination, state_or_province, country, u AS property_count, {dbl('v')} AS total_revenue,
    {big('n')} AS booking_count, {ratio('v', 'u')} AS avg_revenue_per_property, {big('g')} AS unique_guests FROM
    ({ranked('SELECT destination_id, count(DISTINCT property_id) AS u, sum(total_booking_value) AS v, sum(booking_count) AS n, sum(total_guests) AS g FROM daily GROUP BY 1', 'v DESC, destination_id')})
    LEFT JOIN dim_destination USING (destination_id)""")
QUERIES["get_payment_metrics"] = lambda c: revenue.get_payment_metrics(*t(c, "fact_booking_detail"), START, END)
ORACLE["get_payment_metrics"] = with_views(f"""SELECT coalesce(payment_method, 'Unpaid/Pending') AS payment_method, count(*) AS booking_count,
    {dbl('sum(coalesce(payment_amount, 0))')} AS total_payment_amount, {ratio('sum(coalesce(payment_amount, 0))', 'count(*)')} AS avg_payment_amount,
    {ratio('count(payment_amount)', 'count(*)')} * 100 AS payment_completion_rate, {dbl('sum(total_amount)')} AS total_booking_value FROM detail GROUP BY 1""")
QUERIES["get_cancellation_analysis"] = lambda c: revenue.get_cancellation_analysis(*t(c, "fact_booking_detail", "dim_destination"), START, END)
ORACLE["get_cancellation_analysis"] = with_views(f"""SELECT place AS destination, count(*) AS total_bookings, count(*) FILTER (status = 'confirmed') AS confirmed_bookings,
    count(*) FILTER (is_cancelled) AS cancelled_bookings, {ratio('count(*) FILTER (is_cancelled)', 'count(*)')} * 100 AS cancellation_rate,
    {dbl('sum(total_amount)')} AS potential_revenue, {dbl("sum(CASE WHEN status = 'confirmed' THEN total_amount ELSE 0 END)")} AS actual_revenue,
    {dbl('sum(CASE WHEN is_cancelled THEN total_amount ELSE 0 END)')} AS lost_revenue FROM detail LEFT JOIN places USING (destination_id) GROUP BY 1""")
QUERIES["get_revenue_forecast_inputs"] = lambda c: revenue.get_revenue_forecast_inputs(*t(c, "fact_booking_daily", "dim_date"), START, END)
ORACLE["get_revenue_forecast_inputs"] = with_views(f"""SELECT check_in_date AS ds, property_id, {dbl('total_booking_value')} AS y, booking_count, {dbl('avg_booking_value')} AS avg_booking_value,
    {big('dayofweek(check_in_date) + 1')} AS day_of_week, is_weekend, {big('month(check_in_date)')} AS month, {big('quarter(check_in_date)')} AS quarter
    FROM daily LEFT JOIN dim_date ON date = check_in_date""")

# --- engagement ----------------------------------------------------------------------------
QUERIES["get_property_engagement"] = lambda c: engagement.get_property_engagement(*t(c, "fact_property_engagement", "dim_property", "dim_destination"), START, END)
ORACLE["get_property_engagement"] = with_views(f"""SELECT e.property_id, title AS property_title, property_type, place AS destination, {big('views')} AS total_views, {big('viewers')} AS unique_viewers,
    {big('clicks')} AS total_clicks, {big('searches')} AS search_appearances, {ratio('cs', 'cd')} AS conversion_rate, 0.0e0 AS avg_time_on_page, {ratio('clicks', 'views')} * 50 AS engagement_score
    FROM eng e LEFT JOIN dim_property p USING (property_id) LEFT JOIN places USING (destination_id)""")
_FUNNEL = "SELECT place, sum(views) AS views, sum(clicks) AS clicks, coalesce(sum(booked), 0) AS booked FROM eng LEFT JOIN eng_booked USING (property_id) LEFT JOIN dim_property USING (property_id) LEFT JOIN places USING (destination_id) GROUP BY 1"
QUERIES["get_conversion_funnel"] = lambda c: engagement.get_conversion_funnel(*t(c, "fact_property_engagement", "fact_booking_daily", "dim_property", "dim_destination"), START, END)
ORACLE["get_conversion_funnel"] = with_views(f"""SELECT place AS destination, {big('views')} AS total_views, {big('clicks')} AS total_clicks, {big('booked')} AS total_bookings,
    {ratio('clicks', 'views')} * 100 AS view_to_click_rate, {ratio('booked', 'clicks')} * 100 AS click_to_booking_rate, {ratio('booked', 'views')} * 100 AS overall_conversion_rate,
    {ratio('clicks', 'views')} * 50 + {ratio('booked', 'clicks')} * 50 AS funnel_efficiency FROM ({_FUNNEL}) WHERE views > 0""")
QUERIES["get_traffic_source_analysis"] = lambda c: engagement.get_traffic_source_analysis(*t(c, "fact_property_engagement", "fact_booking_daily", "dim_property"), START, END)
ORACLE["get_traffic_source_analysis"] = with_views(f"""SELECT property_type, {big('sum(views)')} AS total_views, {big('sum(viewers)')} AS unique_viewers, {big('sum(clicks)')} AS total_clicks,
    0.0e0 AS avg_time_on_page, {ratio('sum(cs)', 'sum(cd)')} AS conversion_rate, {big('coalesce(sum(booked), 0)')} AS bookings_generated
    FROM eng LEFT JOIN eng_booked USING (property_id) LEFT JOIN dim_property USING (property_id) GROUP BY 1 HAVING sum(views) > 0""")
for _grain, _name in (("day", "CAST(p AS VARCHAR)"), ("week", "'Week ' || weekofyear(p) || ' ' || year(p)")):
    _q = "get_engagement_trends" if _grain == "day" else "get_engagement_trends_week"
    QUERIES[_q] = lambda c, g=_grain: engagement.get_engagement_trends(*t(c, "fact_property_engagement"), START, END, g)
    ORACLE[_q] = with_views(f"""SELECT p AS period_start, {_name} AS period_name, {big('v')} AS total_views, {big('k')} AS total_clicks, {ratio('cs', 'cd')} AS avg_conversion_rate,
        0.0e0 AS avg_time_on_page, u AS unique_properties_viewed, {ratio('k', 'v')} * 40 + {ratio('cs', 'cd')} / 5 * 30 AS engagement_index FROM
        (SELECT CAST(date_trunc('{_grain}', engagement_date) AS DATE) AS p, sum(view_count) AS v, sum(click_count) AS k, sum(conversion_rate) AS cs, count(conversion_rate) AS cd,
        count(DISTINCT property_id) AS u FROM engaged GROUP BY 1)""")
QUERIES["get_top_engaging_properties"] = lambda c: engagement.get_top_engaging_properties(
    *t(c, "fact_property_engagement", "fact_booking_daily", "dim_property", "dim_destination"), START, END, 10)
ORACLE["get_top_engaging_properties"] = with_views(f"""SELECT rank, r.property_id, title AS property_title, place AS destination, total_views, click_through_rate, conversion_rate, avg_time_on_page,
    engagement_score, bookings_generated FROM ({ranked(f'''SELECT property_id, {big('views')} AS total_views, {ratio('clicks', 'views')} * 100 AS click_through_rate, {ratio('cs', 'cd')} AS conversion_rate,
    0.0e0 AS avg_time_on_page, {ratio('clicks', 'views')} * 30 + {ratio('cs', 'cd')} / 5 * 40 AS engagement_score, {big('coalesce(booked, 0)')} AS bookings_generated
    FROM eng LEFT JOIN eng_booked USING (property_id)''', 'engagement_score DESC NULLS LAST, property_id', 10)}) r LEFT JOIN dim_property USING (property_id) LEFT JOIN places USING (destination_id)""")

# --- property ---------------------------------------------------------------------------------
QUERIES["get_property_performance"] = lambda c: property.get_property_performance(
    *t(c, "dim_property", "dim_destination", "fact_booking_detail", "fact_property_engagement"), START, END)
ORACLE["get_property_performance"] = with_views(f"""SELECT property_id, title AS property_title, property_type, place AS destination, {dbl('base_price')} AS base_price, bookings AS total_bookings,
    {dbl('revenue')} AS total_revenue, {ratio('bookings', SPAN)} * 100 AS avg_occupancy_rate, {ratio('revenue', 'bookings')} AS avg_booking_value, {big('nights')} AS total_nights,
    {ratio('cs', 'cd')} AS conversion_rate, {big('views')} AS total_views,
    {dbl('revenue')} / 100000 * 40 + {ratio('bookings', SPAN)} * 100 / 100 * 30 + {ratio('cs', 'cd')} / 5 * 30 AS property_score
    FROM listed LEFT JOIN eng USING (property_id) LEFT JOIN places USING (destination_id)""")
QUERIES["get_availability_by_destination"] = lambda c: property.get_availability_by_destination(*t(c, "dim_destination", "dim_property", "fact_booking_detail"), START, END)
ORACLE["get_availability_by_destination"] = with_views(ranked(f"""SELECT place AS destination, n AS total_properties, a AS active_properties, {big('b')} AS total_bookings,
    {ratio('b', f'({SPAN} * n)')} * 100 AS avg_occupancy_rate, {dbl('r')} AS total_revenue, price AS avg_price, {ratio('a', 'n')} * 100 AS inventory_utilization
    FROM places LEFT JOIN (SELECT destination_id, count(*) AS n, count(*) FILTER (bookings > 0) AS a, sum(bookings) AS b, sum(revenue) AS r, {mean('base_price')} AS price FROM listed GROUP BY 1)
    USING (destination_id)""", "total_properties DESC, destination"))
QUERIES["get_property_type_analysis"] = lambda c: property.get_property_type_analysis(*t(c, "dim_property", "fact_booking_detail", "fact_property_engagement"), START, END)
ORACLE["get_property_type_analysis"] = with_views(f"""SELECT property_type, n AS property_count, {big('b')} AS total_bookings, {dbl('r')} AS total_revenue, {ratio('r', 'b')} AS avg_booking_value,
    {ratio('ni', 'b')} AS avg_nights_per_booking, {ratio('b', f'({SPAN} * n)')} * 100 AS avg_occupancy_rate, {ratio('cs', 'cd')} AS conversion_rate,
    {dbl('r')} / {dbl('sum(r) OVER ()')} * 100 AS market_share_revenue FROM (SELECT property_type, count(*) AS n, sum(bookings) AS b, sum(revenue) AS r, sum(nights) AS ni, sum(cs) AS cs, sum(cd) AS cd
    FROM listed LEFT JOIN eng USING (property_id) GROUP BY 1)""")
QUERIES["get_amenity_impact"] = lambda c: property.get_amenity_impact(*t(c, "dim_property", "fact_booking_detail"), START, END)
ORACLE["get_amenity_impact"] = with_views(f"""SELECT {big('bedrooms')} AS bedrooms, {big('bathrooms')} AS bathrooms, {big('max_guests')} AS max_guests, n AS property_count, {ratio('b', 'n')} AS avg_booking_count,
    {ratio('r', 'n')} AS avg_revenue_per_property, price AS avg_price, {ratio('b', f'({SPAN} * n)')} * 100 AS avg_occupancy_rate,
    {ratio('r', 'n')} / 10000 * 50 + {ratio('b', f'({SPAN} * n)')} * 100 / 100 * 50 AS performance_score FROM (SELECT bedrooms, bathrooms, max_guests, count(*) AS n, sum(bookings) AS b, sum(revenue) AS r,
    {mean('base_price')} AS price FROM listed GROUP BY 1, 2, 3 HAVING count(*) >= 3)""")
QUERIES["get_pricing_analysis"] = lambda c: property.get_pricing_analysis(*t(c, "dim_property", "fact_booking_detail", "fact_property_engagement"), START, END)
ORACLE["get_pricing_analysis"] = with_views(f"""SELECT price_bucket, n AS property_count, {big('b')} AS total_bookings, {dbl('r')} AS total_revenue, {ratio('b', f'({SPAN} * n)')} * 100 AS avg_occupancy_rate,
    round(cr, 6) AS avg_conversion_rate, {ratio('r', 'n')} AS revenue_per_property, {ratio('r', 'n')} / 10000 * 60 + {ratio('b', f'({SPAN} * n)')} * 100 / 100 * 40 AS price_efficiency_score FROM (
    SELECT CASE WHEN base_price < 100 THEN '$0-$99' WHEN base_price < 200 THEN '$100-$199' WHEN base_price < 300 THEN '$200-$299' WHEN base_price < 500 THEN '$300-$499' ELSE '$500+' END AS price_bucket,
    count(*) AS n, sum(bookings) AS b, sum(revenue) AS r, avg({ratio('cs', 'cd')}) AS cr FROM listed LEFT JOIN eng USING (property_id) GROUP BY 1)""")

# --- host ---------------------------------------------------------------------------------------
H = ("dim_host", "dim_property", "fact_booking_detail")
OCC = f"{ratio('bookings', f'({SPAN} * property_count)')} * 100"
CAN = f"{ratio('cancelled', 'bookings')} * 100"
QUERIES["get_host_performance"] = lambda c: host.get_host_performance(*t(c, *H), START, END)
ORACLE["get_host_performance"] = with_views(f"""SELECT host_id, name AS host_name, country, is_verified, rating, property_count, {big('bookings')} AS total_bookings, {dbl('revenue')} AS total_revenue,
    {ratio('revenue', 'bookings')} AS avg_booking_value, {OCC} AS avg_occupancy_rate, {CAN} AS cancellation_rate,
    rating / 5 * 30 + {dbl('revenue')} / 50000 * 40 + {OCC} / 100 * 20 + (100 - {CAN}) / 100 * 10 AS host_performance_score FROM hosted""")
QUERIES["get_host_quality_metrics"] = lambda c: host.get_host_quality_metrics(*t(c, *H), START, END, 20)
ORACLE["get_host_quality_metrics"] = with_views(ranked(f"""SELECT host_id, name AS host_name, is_verified, rating, property_count, {big('bookings')} AS total_bookings,
    CASE WHEN is_verified THEN 95.0e0 ELSE 85.0e0 END AS response_rate, {CAN} AS cancellation_by_host_rate,
    rating / 5 * 40 + CASE WHEN is_verified THEN 95.0e0 ELSE 85.0e0 END / 100 * 30 + (100 - {CAN}) / 100 * 20 + CASE WHEN is_verified THEN 10 ELSE 0 END AS quality_score FROM hosted""",
    "quality_score DESC NULLS LAST, host_id", 20))
QUERIES["get_host_retention_analysis"] = lambda c: host.get_host_retention_analysis(*t(c, *H), START, END)
ORACLE["get_host_retention_analysis"] = with_views(f"""SELECT CASE WHEN is_active AND bookings > 0 THEN 'Active with Bookings' WHEN is_active THEN 'Active without Bookings' ELSE 'Inactive/Churned' END AS host_status,
    count(*) AS host_count, {big('sum(property_count)')} AS total_properties, {big('sum(bookings)')} AS total_bookings, {dbl('sum(revenue)')} AS total_revenue,
    {ratio('sum(property_count)', 'count(*)')} AS avg_properties_per_host, {ratio('sum(revenue)', 'count(*)')} AS avg_revenue_per_host, {mean('rating')} AS avg_rating FROM hosted GROUP BY 1""")
QUERIES["get_host_geographic_distribution"] = lambda c: host.get_host_geographic_distribution(*t(c, *H), START, END)
ORACLE["get_host_geographic_distribution"] = with_views(ranked(f"""SELECT country, count(*) AS host_count, count(*) FILTER (is_verified) AS verified_host_count,
    {ratio('count(*) FILTER (is_verified)', 'count(*)')} * 100 AS verification_rate, {big('sum(property_count)')} AS total_properties, {big('sum(bookings)')} AS total_bookings,
    {dbl('sum(revenue)')} AS total_revenue, {mean('rating')} AS avg_rating, {ratio('sum(revenue)', 'count(*)')} AS avg_revenue_per_host FROM hosted GROUP BY 1""", "host_count DESC, country"))
QUERIES["get_multi_property_hosts"] = lambda c: host.get_multi_property_hosts(*t(c, *H), START, END, 3)
ORACLE["get_multi_property_hosts"] = with_views(f"""SELECT host_id, name AS host_name, country, property_count, {big('bookings')} AS total_bookings, {dbl('revenue')} AS total_revenue,
    {ratio('revenue', 'property_count')} AS avg_revenue_per_property, {OCC} AS avg_occupancy_rate,
    {dbl('revenue')} / 100000 * 50 + {OCC} / 100 * 30 + CAST(property_count AS DOUBLE) / 10 * 20 AS portfolio_performance_score FROM hosted WHERE property_count >= 3""")

# --- customer -------------------------------------------------------------------------------------
U = ("dim_user", "fact_booking_detail")
SEGMENT = """CASE WHEN bookings = 0 THEN 'Inactive' WHEN bookings = 1 THEN 'One-time Booker' WHEN bookings <= 3 THEN 'Repeat Customer' WHEN bookings <= 6 THEN 'Frequent Traveler' ELSE 'VIP Customer' END"""
QUERIES["get_customer_segments"] = lambda c: customer.get_customer_segments(*t(c, *U), START, END)
ORACLE["get_customer_segments"] = with_views(f"""SELECT segment_name, n AS customer_count, {big('b')} AS total_bookings, {dbl('r')} AS total_revenue, {ratio('r', 'b')} AS avg_booking_value,
    {ratio('b', 'n')} AS avg_bookings_per_customer, {dbl('r')} / {dbl('sum(r) OVER ()')} * 100 AS segment_revenue_share, {ratio('ni', 'b')} AS avg_nights_per_booking, {ratio('c', 'b')} * 100 AS cancellation_rate
    FROM (SELECT {SEGMENT} AS segment_name, count(*) AS n, sum(bookings) AS b, sum(revenue) AS r, sum(nights) AS ni, sum(cancelled) AS c FROM booked_users GROUP BY 1)""")
QUERIES["get_customer_ltv"] = lambda c: customer.get_customer_ltv(*t(c, *U), START, END, 100, AS_OF)
ORACLE["get_customer_ltv"] = with_views(ranked(f"""SELECT user_id, any_value(country) AS country, any_value(user_type) AS user_type, count(*) AS total_bookings, {dbl('sum(total_amount)')} AS lifetime_value,
    {ratio('sum(total_amount)', 'count(*)')} AS avg_booking_value, min(check_in_date) AS first_booking_date, max(check_in_date) AS last_booking_date,
    DATE '{AS_OF}' - max(check_in_date) AS days_since_last_booking, max(check_in_date) - min(check_in_date) AS customer_tenure_days
    FROM detail JOIN dim_user USING (user_id) GROUP BY 1""", "lifetime_value DESC, user_id", 100))
QUERIES["get_booking_frequency_analysis"] = lambda c: customer.get_booking_frequency_analysis(*t(c, *U), START, END)
ORACLE["get_booking_frequency_analysis"] = with_views(f"""SELECT f AS booking_frequency_bucket, n AS customer_count, {big('b')} AS total_bookings, {dbl('r')} AS total_revenue, {ratio('r', 'b')} AS avg_booking_value,
    CAST(n AS DOUBLE) / {dbl('sum(n) OVER ()')} * 100 AS customer_percentage, {dbl('r')} / {dbl('sum(r) OVER ()')} * 100 AS revenue_percentage FROM (SELECT CASE WHEN bookings = 0 THEN 'No Bookings' WHEN bookings = 1 THEN '1 Booking'
    WHEN bookings <= 3 THEN '2-3 Bookings' WHEN bookings <= 6 THEN '4-6 Bookings' ELSE '7+ Bookings' END AS f, count(*) AS n, sum(bookings) AS b, sum(revenue) AS r FROM booked_users GROUP BY 1)""")
QUERIES["get_customer_geographic_analysis"] = lambda c: customer.get_customer_geographic_analysis(*t(c, *U), START, END)
ORACLE["get_customer_geographic_analysis"] = with_views(ranked(f"""SELECT country, count(*) AS customer_count, {big('sum(bookings)')} AS total_bookings, {dbl('sum(revenue)')} AS total_revenue,
    {ratio('sum(bookings)', 'count(*)')} AS avg_bookings_per_customer, {ratio('sum(revenue)', 'count(*)')} AS avg_revenue_per_customer, {ratio('sum(revenue)', 'sum(bookings)')} AS avg_booking_value,
    {ratio('sum(cancelled)', 'sum(bookings)')} * 100 AS cancellation_rate FROM booked_users GROUP BY 1""", "customer_count DESC, country"))
QUERIES["get_business_vs_leisure_analysis"] = lambda c: customer.get_business_vs_leisure_analysis(*t(c, *U), START, END)
ORACLE["get_business_vs_leisure_analysis"] = with_views(f"""SELECT CASE WHEN is_business_booking THEN 'Business' ELSE 'Leisure' END AS booking_type, count(DISTINCT u.user_id) AS customer_count, count(*) AS total_bookings,
    {dbl('sum(total_amount)')} AS total_revenue, {mean('total_amount')} AS avg_booking_value, {mean('nights_booked')} AS avg_nights_booked, {mean('days_between_booking_and_checkin')} AS avg_lead_time_days,
    {ratio('count(*) FILTER (is_cancelled)', 'count(*)')} * 100 AS cancellation_rate, {ratio('count(payment_amount)', 'count(*)')} * 100 AS payment_completion_rate
    FROM detail f LEFT JOIN dim_user u ON u.user_id = f.user_id GROUP BY 1""")
QUERIES["get_vip_customer_property_preferences"] = lambda c: customer.get_vip_customer_property_preferences(*t(c, "fact_booking_detail", "dim_property"), START, END)
ORACLE["get_vip_customer_property_preferences"] = with_views(f"""SELECT property_type, u AS vip_customer_count, n AS vip_bookings, {dbl('r')} AS vip_revenue, {ratio('r', 'n')} AS avg_booking_value,
    {dbl('r')} / {dbl('sum(r) OVER ()')} * 100 AS pct_of_total_vip_revenue FROM (SELECT property_type, count(DISTINCT user_id) AS u, count(*) AS n, sum(total_amount) AS r FROM detail JOIN dim_property USING (property_id)
    WHERE user_id IN (SELECT user_id FROM per_user WHERE CAST(revenue AS DOUBLE) >= (SELECT quantile_cont(CAST(revenue AS DOUBLE), 0.95) FROM per_user)) GROUP BY 1)""")

QUERIES["get_revenue_by_destination_first"] = lambda c: revenue.get_revenue_by_destination(*t(c, "fact_booking_daily", "dim_destination"), START, END, 7)
ORACLE["get_revenue_by_destination_first"] = f"SELECT * FROM ({ORACLE['get_revenue_by_destination']}) WHERE rank <= 7"
