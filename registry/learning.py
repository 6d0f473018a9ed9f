"""Features, labels, evaluation, segmentation and prediction summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from innsight.functions import predictions as pf
from innsight.plans import baseline, evaluation, features
from oracle.base import add_view, big, dbl, mean, ratio, with_views
from registry import reports  # noqa: F401 - shared views
from registry.common import AS_OF

QUERIES: dict = {}
ORACLE: dict = {}

DAY = "2000-01-31"
CUTOFF = "2000-08-01"
D = f"DATE '{DAY}'"
PEAK = "(6, 7, 8, 12)"


def t(c, *names):
    return [c.table(n) for n in names]


def stored(c, name, build):
    """A feature table: one row per key in each task, so it is written without a further shuffle."""
    return c.store(name, build, rebalance=False)


# --- feature tables ------------------------------------------------------------------------
def property_features(c):
    return stored(c, "property_features", lambda: features.property_features(*t(c, "dim_property", "fact_booking_daily", "fact_property_engagement"), DAY))


def user_features(c):
    return stored(c, "user_features", lambda: features.user_features(*t(c, "dim_user", "fact_booking_detail"), AS_OF))


LISTING_SQL = f"property_id, property_type, {big('bedrooms')} AS bedrooms, {big('bathrooms')} AS bathrooms, {big('max_guests')} AS max_guests, {dbl('base_price')} AS base_price, destination_id, host_id, property_latitude, property_longitude"
add_view("f_property", f"""SELECT {LISTING_SQL}, {big('coalesce(b, 0)')} AS bookings_30d, coalesce(r, 0) AS revenue_30d, coalesce(ab, 0) AS avg_booking_value_30d, coalesce(an, 0) AS avg_nights_30d,
    {big('coalesce(v, 0)')} AS views_30d, {big('coalesce(k, 0)')} AS clicks_30d, coalesce(cr, 0) AS avg_conversion_rate_30d, CASE WHEN coalesce(b, 0) > 0 THEN {ratio('r', 'b')} ELSE 0 END AS revenue_per_booking,
    CASE WHEN coalesce(v, 0) > 0 THEN {ratio('k', 'v')} ELSE 0 END AS click_through_rate FROM dim_property
    LEFT JOIN (SELECT property_id, sum(booking_count) AS b, {dbl('sum(total_booking_value)')} AS r, {mean('avg_booking_value')} AS ab, {mean('avg_nights_booked')} AS an FROM fact_booking_daily WHERE check_in_date BETWEEN {D} - 30 AND {D} GROUP BY 1) USING (property_id)
    LEFT JOIN (SELECT property_id, sum(view_count) AS v, sum(click_count) AS k, {mean('conversion_rate')} AS cr FROM fact_property_engagement WHERE engagement_date BETWEEN {D} - 30 AND {D} GROUP BY 1) USING (property_id)""")
QUERIES["features_property"] = lambda c: features.property_features(*t(c, "dim_property", "fact_booking_daily", "fact_property_engagement"), DAY)
ORACLE["features_property"] = with_views("SELECT * FROM f_property")

add_view("f_user", f"""SELECT user_id, country, user_type, is_business, created_at AS account_created_date, coalesce(n, 0) AS total_bookings, coalesce(s, 0) AS total_spend, coalesce(a, 0) AS avg_booking_value,
    coalesce(x, 0) AS cancelled_bookings, coalesce(idle, 0) AS days_since_last_booking, coalesce(gap, 0) AS avg_days_between_bookings, CASE WHEN n > 0 THEN {ratio('x', 'n')} ELSE 0 END AS cancellation_rate,
    DATE '{AS_OF}' - created_at AS tenure_days, coalesce(n, 0) > 1 AS is_repeat FROM dim_user LEFT JOIN (SELECT user_id, count(*) AS n, {dbl('sum(total_amount)')} AS s, {mean('total_amount')} AS a,
    count(*) FILTER (is_cancelled) AS x, DATE '{AS_OF}' - max(created_at) AS idle FROM fact_booking_detail GROUP BY 1) USING (user_id)
    LEFT JOIN (SELECT user_id, {mean('g')} AS gap FROM (SELECT user_id, created_at - lag(created_at) OVER (PARTITION BY user_id ORDER BY created_at, booking_id) AS g FROM fact_booking_detail) GROUP BY 1) USING (user_id)""")
QUERIES["features_user"] = lambda c: features.user_features(*t(c, "dim_user", "fact_booking_detail"), AS_OF)
ORACLE["features_user"] = with_views("SELECT * FROM f_user")


def roll(col: str, n: int, by: str, order: str) -> str:
    w = f"OVER (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" if by else f"OVER (ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CAST(sum({col}) {w} AS DOUBLE) / nullif(count({col}) {w}, 0)"


QUERIES["features_engagement"] = lambda c: features.engagement_features(*t(c, "fact_property_engagement"))
ORACLE["features_engagement"] = with_views(f"""SELECT property_id, engagement_date, view_count, unique_user_views, click_count, search_count, {dbl('conversion_rate')} AS conversion_rate, {dbl('avg_time_on_page')} AS avg_time_on_page,
    {big('dayofweek(engagement_date) + 1')} AS day_of_week, dayofweek(engagement_date) IN (0, 6) AS is_weekend, {roll('view_count', 7, 'property_id', 'engagement_date')} AS views_7d_avg,
    {roll('click_count', 7, 'property_id', 'engagement_date')} AS clicks_7d_avg, {roll('conversion_rate', 7, 'property_id', 'engagement_date')} AS conversion_rate_7d_avg FROM fact_property_engagement""")


def _locations(c):
    """Location features beside the listings they describe."""
    count = c.table("dim_property").groupBy("destination_id").agg(F.count(F.lit(1)).alias("listings"))
    return features.location_features(c.table("dim_destination")).join(count, "destination_id", "left")


QUERIES["features_location"] = _locations
ORACLE["features_location"] = with_views("""SELECT destination_id, destination, country, state_or_province, state_or_province_code, listings FROM dim_destination LEFT JOIN
    (SELECT destination_id, count(*) AS listings FROM dim_property GROUP BY 1) USING (destination_id)""")

QUERIES["features_property_weather"] = lambda c: features.property_weather_features(
    *t(c, "dim_property", "dim_destination", "fact_booking_daily", "fact_property_engagement", "fact_weather_daily", "dim_weather_location"), DAY)


def win(lo, hi, col):
    cond = f"({D} - check_in_date) BETWEEN 0 AND {hi}" if lo is None else f"({D} - check_in_date) BETWEEN {lo} AND {hi}"
    return f"coalesce(sum({col}) FILTER ({cond}), 0)"


def win_mean(hi, col):
    return f"CAST(sum({col}) FILTER (({D} - check_in_date) BETWEEN 0 AND {hi}) AS DOUBLE) / nullif(count({col}) FILTER (({D} - check_in_date) BETWEEN 0 AND {hi}), 0)"


_WEATHER_COLS = {"avg_temp_min_30d": '"temperatureMin"', "avg_temp_max_30d": '"temperatureMax"', "avg_realfeel_min_30d": '"realFeelMin"', "avg_realfeel_max_30d": '"realFeelMax"',
                 "avg_hours_sun_30d": '"hoursOfSun"', "avg_precip_prob_30d": '"precipitationProbability"'}
ORACLE["features_property_weather"] = with_views(f"""SELECT {LISTING_SQL.replace('destination_id,', 'p.destination_id AS destination_id,')}, {', '.join(f'{big(f"coalesce({x}, 0)")} AS {x}' for x in ('bookings_30d', 'bookings_90d', 'bookings_365d', 'bookings_31_60d', 'bookings_61_90d', 'views_30d', 'clicks_30d', 'destination_total_bookings', 'max_thunderstorm_prob_30d', 'precip_days_30d'))},
    {', '.join(f'coalesce({x}, 0) AS {x}' for x in ('revenue_30d', 'avg_booking_value_30d', 'avg_nights_30d', 'revenue_90d', 'avg_booking_value_90d', 'revenue_365d', 'avg_conversion_rate_30d', 'destination_avg_booking_value', 'destination_total_revenue', 'destination_revpar', *_WEATHER_COLS))},
    CASE WHEN bookings_31_60d > 0 THEN {ratio('bookings_30d - bookings_31_60d', 'bookings_31_60d')} ELSE 0 END AS booking_trend_30_60d,
    CASE WHEN bookings_61_90d > 0 THEN {ratio('bookings_31_60d - bookings_61_90d', 'bookings_61_90d')} ELSE 0 END AS booking_trend_60_90d,
    CASE WHEN bookings_30d > 0 THEN {ratio('revenue_30d', 'bookings_30d')} ELSE 0 END AS revenue_per_booking, CASE WHEN views_30d > 0 THEN {ratio('clicks_30d', 'views_30d')} ELSE 0 END AS click_through_rate,
    {D} AS feature_date, 2::BIGINT AS day_of_week, FALSE AS is_weekend, 1::BIGINT AS month, 1::BIGINT AS quarter, FALSE AS is_peak_season, 0::BIGINT AS is_holiday
    FROM dim_property p LEFT JOIN (SELECT property_id, {win(None, 30, 'booking_count')} AS bookings_30d, {dbl(win(None, 30, 'total_booking_value'))} AS revenue_30d, {win_mean(30, 'avg_booking_value')} AS avg_booking_value_30d,
        {win_mean(30, 'avg_nights_booked')} AS avg_nights_30d, {win(None, 90, 'booking_count')} AS bookings_90d, {dbl(win(None, 90, 'total_booking_value'))} AS revenue_90d, {win_mean(90, 'avg_booking_value')} AS avg_booking_value_90d,
        {win(None, 365, 'booking_count')} AS bookings_365d, {dbl(win(None, 365, 'total_booking_value'))} AS revenue_365d, {win(31, 60, 'booking_count')} AS bookings_31_60d, {win(61, 90, 'booking_count')} AS bookings_61_90d FROM fact_booking_daily GROUP BY 1) USING (property_id)
    LEFT JOIN (SELECT property_id, sum(view_count) AS views_30d, sum(click_count) AS clicks_30d, {mean('conversion_rate')} AS avg_conversion_rate_30d FROM fact_property_engagement WHERE ({D} - engagement_date) BETWEEN 0 AND 30 GROUP BY 1) USING (property_id)
    LEFT JOIN (SELECT p.destination_id, {mean('avg_booking_value')} AS destination_avg_booking_value, sum(booking_count) AS destination_total_bookings, {dbl('sum(total_booking_value)')} AS destination_total_revenue,
        {ratio('sum(total_booking_value)', 'sum(booking_count)')} AS destination_revpar FROM fact_booking_daily f JOIN dim_property p USING (property_id) WHERE check_in_date <= {D} GROUP BY 1) g ON g.destination_id = p.destination_id
    LEFT JOIN (SELECT CAST(substr("locationKey", 2) AS BIGINT) AS dest, {', '.join(f'{mean(e)} AS {n}' for n, e in _WEATHER_COLS.items())}, max("thunderstormProbability") AS max_thunderstorm_prob_30d,
        count(*) FILTER (is_precipitation_expected) AS precip_days_30d FROM (SELECT *, row_number() OVER (PARTITION BY "locationKey" ORDER BY date DESC) AS rn FROM fact_weather_daily WHERE date <= {D}) WHERE rn <= 30 GROUP BY 1) w ON w.dest = p.destination_id""")


def _lookup(c):
    """Conversion labels with listing features and, at the day's state, weather of the destination."""
    labels = features.conversion_labels(*t(c, "fact_property_engagement", "fact_booking_detail"))
    weather = c.table("fact_weather_daily").where("is_precipitation_expected").select(F.expr("CAST(substr(locationKey, 2) AS BIGINT)").alias("destination_id"), "date", "rainProbability")
    return features.training_set(
        labels,
        [
            features.FeatureLookup(property_features(c), ("property_id",), ("property_type", "bedrooms", "destination_id", "views_30d", "click_through_rate")),
            features.FeatureLookup(weather, ("destination_id",), ("rainProbability",), "date"),
        ],
        "engagement_date",
    )


_LABEL_CONV = f"""SELECT property_id, engagement_date, {big('coalesce(c, 0)')} AS is_converted, {big('month(engagement_date)')} AS month, {big(f'month(engagement_date) IN {PEAK}')} AS is_peak_season
    FROM fact_property_engagement LEFT JOIN (SELECT DISTINCT property_id, created_at AS engagement_date, 1 AS c FROM fact_booking_detail) USING (property_id, engagement_date)"""
add_view("l_conversion", _LABEL_CONV)
QUERIES["feature_lookup"] = _lookup
ORACLE["feature_lookup"] = with_views("""SELECT l.*, p.property_type, p.bedrooms, p.destination_id, p.views_30d, p.click_through_rate, w.date, w."rainProbability" FROM l_conversion l LEFT JOIN f_property p USING (property_id)
    ASOF LEFT JOIN (SELECT CAST(substr("locationKey", 2) AS BIGINT) AS dest, date, "rainProbability" FROM fact_weather_daily WHERE is_precipitation_expected) w ON w.dest = p.destination_id AND l.engagement_date >= w.date""")



def _lookups(c):
    """Conversion labels with the newest booking day and the newest day of clicks of the listing: two tables, one sweep."""
    labels, daily, engagement = features.conversion_labels(*t(c, "fact_property_engagement", "fact_booking_detail")), *t(c, "fact_booking_daily", "fact_property_engagement")
    key = ("property_id",)
    return features.training_set(labels, [
        features.FeatureLookup(daily, key, ("booking_count", "total_guests"), "check_in_date"),
        features.FeatureLookup(engagement.where("click_count > 0"), key, ("click_count",), "engagement_date"),
    ], "engagement_date")


QUERIES["feature_lookup_sweep"] = _lookups
ORACLE["feature_lookup_sweep"] = with_views(f"""SELECT l.*, d.check_in_date, {big('d.booking_count')} AS booking_count, {big('d.total_guests')} AS total_guests, e.engagement_date AS engagement_date_asof, {big('e.click_count')} AS click_count
    FROM l_conversion l ASOF LEFT JOIN fact_booking_daily d ON d.property_id = l.property_id AND l.engagement_date >= d.check_in_date
    ASOF LEFT JOIN (SELECT * FROM fact_property_engagement WHERE click_count > 0) e ON e.property_id = l.property_id AND l.engagement_date >= e.engagement_date""")

# --- labels -------------------------------------------------------------------------------------
QUERIES["label_conversion"] = lambda c: features.conversion_labels(*t(c, "fact_property_engagement", "fact_booking_detail"))
ORACLE["label_conversion"] = with_views("SELECT * FROM l_conversion")
QUERIES["label_ltv_12m"] = lambda c: features.ltv_labels(c.table("fact_booking_detail"), CUTOFF)
ORACLE["label_ltv_12m"] = with_views(f"""SELECT user_id, {dbl(f"coalesce(sum(total_amount) FILTER (created_at > DATE '{CUTOFF}'), 0)")} AS ltv_12m FROM fact_booking_detail GROUP BY 1
    HAVING count(*) FILTER (created_at <= DATE '{CUTOFF}') > 0""")
QUERIES["label_price"] = lambda c: features.price_labels(c.table("fact_booking_daily"))
ORACLE["label_price"] = with_views(f"""SELECT property_id, check_in_date, {ratio('total_booking_value', 'CAST(booking_count * avg_nights_booked AS DOUBLE)')} AS optimal_price, booking_count AS daily_bookings,
    {big('month(check_in_date)')} AS month, {big('quarter(check_in_date)')} AS quarter, {big(f'month(check_in_date) IN {PEAK}')} AS is_peak_season FROM fact_booking_daily WHERE avg_nights_booked > 0""")
QUERIES["label_churn"] = lambda c: features.churn_labels(user_features(c), c.table("fact_booking_detail"), AS_OF).select(
    "user_id", "total_bookings", "last_booking_date", "days_since_last_booking", "is_churned")
ORACLE["label_churn"] = with_views(f"""SELECT user_id, total_bookings, last AS last_booking_date, {big('idle')} AS days_since_last_booking, {big('idle > quantile_cont(idle, 0.5) OVER ()')} AS is_churned FROM (SELECT user_id, total_bookings, last,
    coalesce(DATE '{AS_OF}' - last, 365) AS idle FROM f_user LEFT JOIN (SELECT user_id, max(created_at) AS last FROM fact_booking_detail GROUP BY 1) USING (user_id))""")


def demand_set(c):
    return features.demand_training_set(*t(c, "fact_booking_daily", "dim_property", "dim_destination"), property_features(c))


def _rounded_demand(c):
    out = demand_set(c)
    return out.withColumns({n: F.round(n, 6) for n in ("sin_month", "cos_month", "sin_week", "cos_week")})


QUERIES["demand_training_set"] = _rounded_demand
_CYC = lambda fn, v, n: f"round({fn}({v} * 2 * 3.14159e0 / {n}), 6)"
ORACLE["demand_training_set"] = with_views(f"""SELECT f.property_id, check_in_date, booking_count, {dbl('total_booking_value')} AS total_booking_value, {dbl('avg_nights_booked')} AS avg_nights_booked,
    {dbl('avg_booking_value')} AS avg_booking_value, p.destination_id, d.destination, d.country, {big('month(check_in_date)')} AS month, {big('quarter(check_in_date)')} AS quarter, {big('dayofweek(check_in_date) + 1')} AS day_of_week,
    {big('day(check_in_date)')} AS day_of_month, {big('weekofyear(check_in_date)')} AS week_of_year, {dbl('dayofweek(check_in_date) IN (0, 6)')} AS is_weekend, {dbl(f'month(check_in_date) IN {PEAK}')} AS is_peak_season, 0.0e0 AS is_holiday,
    {_CYC('sin', 'month(check_in_date)', 12)} AS sin_month, {_CYC('cos', 'month(check_in_date)', 12)} AS cos_month, {_CYC('sin', 'weekofyear(check_in_date)', 52)} AS sin_week, {_CYC('cos', 'weekofyear(check_in_date)', 52)} AS cos_week,
    x.* EXCLUDE (property_id, destination_id, host_id) FROM fact_booking_daily f JOIN dim_property p ON p.property_id = f.property_id JOIN dim_destination d ON d.destination_id = p.destination_id LEFT JOIN f_property x ON x.property_id = f.property_id""")
QUERIES["seasonal_features"] = lambda c: features.seasonal_features(c.table("fact_booking_daily").select("property_id", "check_in_date", "booking_count"))
_PW = "OVER (PARTITION BY property_id ORDER BY check_in_date)"
ORACLE["seasonal_features"] = with_views(f"""SELECT a.property_id, a.check_in_date, booking_count, {big('a.check_in_date - min(a.check_in_date) OVER ()')} AS days_since_start,
    {big(f'coalesce(lag(booking_count, 7) {_PW}, 0)')} AS booking_count_lag_7d, {big(f'coalesce(lag(booking_count, 30) {_PW}, 0)')} AS booking_count_lag_30d,
    {roll('booking_count', 7, 'a.property_id', 'a.check_in_date')} AS booking_count_ma_7d, {roll('booking_count', 30, 'a.property_id', 'a.check_in_date')} AS booking_count_ma_30d,
    coalesce(CAST(booking_count AS DOUBLE) / nullif(lag(booking_count, 30) {_PW}, 0) - 1, 0) AS mom_growth_rate, {big('coalesce(y, 0)')} AS booking_count_yoy,
    CASE WHEN y > 0 THEN {ratio('booking_count - y', 'y')} ELSE 0 END AS yoy_growth_rate FROM fact_booking_daily a LEFT JOIN (SELECT property_id AS pid, CAST(check_in_date + INTERVAL 12 MONTHS AS DATE) AS day, max(booking_count) AS y
    FROM fact_booking_daily GROUP BY 1, 2) ON pid = a.property_id AND day = a.check_in_date""".replace("PARTITION BY property_id ORDER BY check_in_date)", "PARTITION BY a.property_id ORDER BY a.check_in_date)"))


def revenue_series(c):
    return features.revenue_series(c.table("fact_booking_daily"), AS_OF)


QUERIES["revenue_series_features"] = revenue_series
ORACLE["revenue_series_features"] = with_views(f"""SELECT ds, y, booking_count, coalesce(first_value(l7 IGNORE NULLS) OVER (ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS revenue_lag_7d,
    coalesce(first_value(l30 IGNORE NULLS) OVER (ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS revenue_lag_30d, m7 AS revenue_ma_7d, m30 AS revenue_ma_30d, {big('(dayofweek(ds) + 6) % 7')} AS day_of_week,
    {big('month(ds)')} AS month, {big('quarter(ds)')} AS quarter, {big('dayofweek(ds) IN (0, 6)')} AS is_weekend FROM (SELECT ds, {dbl('v')} AS y, booking_count, lag({dbl('v')}, 7) OVER (ORDER BY ds) AS l7, lag({dbl('v')}, 30) OVER (ORDER BY ds) AS l30,
    {roll('v', 7, '', 'ds')} AS m7, {roll('v', 30, '', 'ds')} AS m30 FROM (SELECT check_in_date AS ds, sum(total_booking_value) AS v, count(*) AS booking_count FROM fact_booking_daily GROUP BY 1))""")

# --- encoding, signatures, segmentation ------------------------------------------------------------
add_view("type_codes", "SELECT property_type AS value, row_number() OVER (ORDER BY property_type) - 1 AS code FROM (SELECT DISTINCT property_type FROM dim_property)")


def codes(c):
    return stored(c, "type_codes", lambda: features.category_codes(c.table("dim_property"), "property_type"))


QUERIES["encode_category"] = lambda c: features.encode(c.table("dim_property").select("property_id", "property_type"), "property_type", codes(c).where("value <> 'SMALL'"), "type_code")
ORACLE["encode_category"] = with_views("SELECT property_id, property_type, CASE WHEN property_type = 'SMALL' THEN -1 ELSE code END AS type_code FROM dim_property JOIN type_codes ON value = property_type")
SIGNATURE = [("base_price", "float"), ("bedrooms", "long"), ("rating_hint", "double"), ("is_big", "boolean"), ("huge", "integer"), ("title", "double"), ("flag_text", "boolean"), ("property_id", "long")]


def _signature(c):
    df = c.table("dim_property").withColumns({"is_big": F.col("max_guests") - 4, "huge": F.col("property_id") * 100_000_000, "flag_text": F.when(F.col("property_id") % 2 == 0, "Yes").otherwise("no")})
    return features.conform_signature(df, SIGNATURE)


QUERIES["conform_signature"] = _signature
ORACLE["conform_signature"] = with_views(f"""SELECT {dbl('CAST(base_price AS FLOAT)')} AS base_price, {big('bedrooms')} AS bedrooms, 0.0e0 AS rating_hint, max_guests <> 4 AS is_big, {big('least(property_id * 100000000, 2147483647)')} AS huge,
    0.0e0 AS title, property_id % 2 = 0 AS flag_text, property_id FROM dim_property""")


def segment_input(c):
    return user_features(c).withColumns({
        "predicted_ltv_12m": F.col("total_spend") * baseline.LTV_MULTIPLE, "churn_score": F.least(F.col("days_since_last_booking") / 365.0, F.lit(1.0))})


QUERIES["customer_segmentation"] = lambda c: features.customer_segments(segment_input(c)).select(
    "user_id", "primary_segment", "secondary_segment", "engagement_score", "price_sensitivity_score", "ltv_decile", "segment_confidence", "predicted_ltv_12m")
ORACLE["customer_segmentation"] = with_views(f"""SELECT user_id, seg AS primary_segment, CASE WHEN seg = 'high_value' AND total_bookings >= 3 THEN 'repeat_travelers' WHEN seg = 'at_risk' AND avg_booking_value < 200 THEN 'price_sensitive' END AS secondary_segment,
    round({dbl('''CASE WHEN total_bookings > 0 THEN 0.3 ELSE 0 END + CASE WHEN days_since_last_booking < 30 THEN 0.3 WHEN days_since_last_booking < 90 THEN 0.15 ELSE 0 END +
    CASE WHEN avg_booking_value > 500 THEN 0.2 WHEN avg_booking_value > 200 THEN 0.1 ELSE 0 END + CASE WHEN is_repeat THEN 0.2 ELSE 0 END''')}, 4) AS engagement_score,
    {dbl('CASE WHEN avg_booking_value < 100 THEN 1.0 WHEN avg_booking_value < 200 THEN 0.7 WHEN avg_booking_value < 300 THEN 0.4 ELSE 0.2 END')} AS price_sensitivity_score,
    ntile(10) OVER (ORDER BY ltv, user_id) AS ltv_decile, {dbl('''CASE WHEN seg = 'high_value' THEN CASE WHEN ltv > 5000 THEN 0.95 ELSE 0.85 END WHEN seg = 'at_risk' THEN CASE WHEN churn > 0.9 THEN 0.95 ELSE 0.8 END
    WHEN seg = 'repeat_travelers' THEN CASE WHEN total_bookings > 5 THEN 0.9 ELSE 0.8 END ELSE 0.75 END''')} AS segment_confidence, ltv AS predicted_ltv_12m FROM (SELECT *, CASE WHEN ltv > 2500 AND total_bookings >= 5 THEN 'high_value'
    WHEN churn > 0.7 OR days_since_last_booking > 90 THEN 'at_risk' WHEN total_bookings >= 3 AND avg_days_between_bookings < 180 THEN 'repeat_travelers' WHEN avg_booking_value < 200 AND cancelled_bookings > 0 THEN 'price_sensitive'
    WHEN total_bookings < 2 AND tenure_days < 30 THEN 'new_prospects' ELSE 'general' END AS seg FROM (SELECT *, total_spend * 1.5e0 AS ltv, least(days_since_last_booking / 365.0e0, 1.0e0) AS churn FROM f_user))""")

# --- evaluation: a tariff of 300 per night stands in for a model ---------------------------------------
def tariff(c):
    return c.table("fact_booking_detail").select(F.col("total_amount").alias("label"), (F.col("nights_booked") * 300).alias("prediction"))


_TARIFF = "SELECT CAST(total_amount AS DOUBLE) AS y, CAST(nights_booked * 300 AS DOUBLE) AS p FROM fact_booking_detail"


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


QUERIES["eval_regression"] = lambda c: rounded(evaluation.regression_metrics(tariff(c)), "rmse", "mae", "r2", "mape")
ORACLE["eval_regression"] = with_views(f"""SELECT count(*) AS row_count, round(sqrt(sum((y - p) ^ 2) / count(*)), 6) AS rmse, round(sum(abs(y - p)) / count(*), 6) AS mae, round(1 - sum((y - p) ^ 2) / (count(*) * var_pop(y)), 6) AS r2,
    round(sum(abs((y - p) / (y + 1))) / count(*) * 100, 6) AS mape FROM ({_TARIFF})""")
QUERIES["eval_regression_bands"] = lambda c: rounded(evaluation.error_by_band(tariff(c)), "mae")
ORACLE["eval_regression_bands"] = with_views(f"""SELECT CASE WHEN y <= 500 THEN 'Low' WHEN y <= 1000 THEN 'Medium' WHEN y <= 2500 THEN 'High' ELSE 'VIP' END AS segment, count(*) AS row_count, round(sum(abs(y - p)) / count(*), 6) AS mae
    FROM ({_TARIFF}) WHERE y > 0 GROUP BY 1""")
QUERIES["eval_price_lift"] = lambda c: rounded(evaluation.price_lift(tariff(c)), "mean_actual", "mean_predicted", "mape", "revenue_lift_pct")
ORACLE["eval_price_lift"] = with_views(f"""SELECT round(a, 6) AS mean_actual, round(b, 6) AS mean_predicted, round(m, 6) AS mape, round((b - a) / a * 100, 6) AS revenue_lift_pct FROM (SELECT sum(y) / count(*) AS a, sum(p) / count(*) AS b,
    sum(CASE WHEN y <> 0 THEN abs((y - p) / y) END) / count(*) FILTER (y <> 0) * 100 AS m FROM ({_TARIFF}))""")
QUERIES["eval_classification"] = lambda c: evaluation.classification_metrics(c.table("fact_booking_detail").select(
    F.col("is_cancelled").cast("int").alias("label"), (F.col("days_between_booking_and_checkin") / 60.0).cast("double").alias("score")))
ORACLE["eval_classification"] = with_views("""SELECT n AS row_count, CAST((wins - pos * (pos + 1) / 2.0) AS DOUBLE) / (pos * neg) AS auc, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / pos AS recall,
    2 * (CAST(tp AS DOUBLE) / (tp + fp)) * (CAST(tp AS DOUBLE) / pos) / (CAST(tp AS DOUBLE) / (tp + fp) + CAST(tp AS DOUBLE) / pos) AS f1 FROM (SELECT count(*) AS n, count(*) FILTER (is_cancelled) AS pos, count(*) FILTER (NOT is_cancelled) AS neg,
    sum(avg_rank) FILTER (is_cancelled) AS wins, count(*) FILTER (is_cancelled AND s > 0.5) AS tp, count(*) FILTER (NOT is_cancelled AND s > 0.5) AS fp FROM (SELECT is_cancelled, days_between_booking_and_checkin / 60.0e0 AS s,
    rank() OVER (ORDER BY days_between_booking_and_checkin) + (count(*) OVER (PARTITION BY days_between_booking_and_checkin) - 1) / 2.0e0 AS avg_rank FROM fact_booking_detail))""")

# --- prediction summaries over repeatable baseline predictions --------------------------------------------
def demand(c):
    return stored(c, "demand_predictions", lambda: baseline.demand(*t(c, "dim_property", "fact_booking_daily"), codes(c), AS_OF))


def conversion(c):
    labels = features.conversion_labels(*t(c, "fact_property_engagement", "fact_booking_detail"))
    return stored(c, "conversion_predictions", lambda: baseline.conversion(c.table("dim_property"), labels, codes(c), AS_OF))


def pricing(c):
    return stored(c, "pricing_recommendations", lambda: baseline.pricing(c.table("fact_booking_daily"), AS_OF))


def ltv(c):
    return stored(c, "customer_ltv_predictions", lambda: baseline.lifetime_value(user_features(c), AS_OF))


S = f"DATE '{AS_OF}' AS scoring_date"
add_view("p_demand", f"SELECT property_id, destination_id, code AS property_type, pb AS predicted_bookings FROM dim_property p JOIN type_codes ON value = p.property_type JOIN (SELECT property_id, {mean('booking_count')} AS pb FROM fact_booking_daily GROUP BY 1) USING (property_id)")
add_view("p_conversion", f"SELECT property_id, destination_id, code AS property_type, cp AS conversion_probability, {big('cp > 0.5')} AS predicted_conversion FROM dim_property p JOIN type_codes ON value = p.property_type JOIN (SELECT property_id, {mean('is_converted')} AS cp FROM l_conversion GROUP BY 1) USING (property_id)")
add_view("p_pricing", f"""SELECT property_id, {big('month(check_in_date)')} AS month, {big('quarter(check_in_date)')} AS quarter, {big(f'month(check_in_date) IN {PEAK}')} AS is_peak_season, {ratio('sum(total_booking_value)', 'CAST(sum(booking_count * avg_nights_booked) AS DOUBLE)')} AS recommended_price
    FROM fact_booking_daily WHERE avg_nights_booked > 0 GROUP BY 1, 2, 3, 4""")
add_view("p_ltv", "SELECT *, total_spend * 1.5e0 AS predicted_ltv_12m, CASE WHEN total_spend * 1.5e0 >= 2500 THEN 'VIP' WHEN total_spend * 1.5e0 >= 1000 THEN 'High' WHEN total_spend * 1.5e0 >= 500 THEN 'Medium' ELSE 'Low' END AS ltv_segment FROM f_user")

QUERIES["get_demand_predictions"] = lambda c: pf.get_demand_predictions(demand(c))
ORACLE["get_demand_predictions"] = with_views(f"""SELECT destination_id, property_type, round(avg(predicted_bookings), 6) AS avg_predicted_bookings, max(predicted_bookings) AS max_predicted_bookings, count(*) AS prediction_count, {S}, 'demand_predictor' AS model_name
    FROM p_demand GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2""")
QUERIES["get_conversion_predictions"] = lambda c: pf.get_conversion_predictions(conversion(c))
ORACLE["get_conversion_predictions"] = with_views(f"""SELECT destination_id, property_type, round(avg(conversion_probability), 6) AS avg_conversion_probability, max(conversion_probability) AS max_conversion_probability,
    round(avg(predicted_conversion), 6) AS predicted_conversion_rate, count(*) AS prediction_count, {S}, 'conversion_predictor' AS model_name FROM p_conversion GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2""")
QUERIES["get_pricing_recommendations"] = lambda c: pf.get_pricing_recommendations(pricing(c))
ORACLE["get_pricing_recommendations"] = with_views(f"""SELECT month, quarter, is_peak_season, round(avg(recommended_price), 6) AS avg_recommended_price, min(recommended_price) AS min_recommended_price, max(recommended_price) AS max_recommended_price,
    count(*) AS prediction_count, {S}, 'pricing_optimizer' AS model_name FROM p_pricing GROUP BY 1, 2, 3""")
QUERIES["get_pricing_by_destination"] = lambda c: pf.get_pricing_by_destination(*t(c, "dim_property", "dim_destination"), pricing(c), "Nation_1", AS_OF)
ORACLE["get_pricing_by_destination"] = with_views(f"""SELECT *, '$' || CAST(round(min_base_price * f) AS BIGINT) || ' - $' || CAST(round(max_base_price * f) AS BIGINT) AS recommended_price_range FROM (SELECT destination, property_type, count(*) AS property_count, {mean('base_price')} AS avg_base_price,
    {dbl('min(base_price)')} AS min_base_price, {dbl('max(base_price)')} AS max_base_price, any_value(f) AS ml_seasonal_adjustment FROM dim_property JOIN dim_destination USING (destination_id), (SELECT round(avg(recommended_price), 6) / 100 AS f FROM p_pricing WHERE month = 8)
    WHERE lower(destination) LIKE '%nation_1%' GROUP BY 1, 2), (SELECT round(avg(recommended_price), 6) / 100 AS f FROM p_pricing WHERE month = 8)""").replace("SELECT *, '$'", "SELECT * EXCLUDE (f), '$'")
QUERIES["get_customer_ltv_predictions"] = lambda c: pf.get_customer_ltv_predictions(ltv(c))
_LTV = "round(avg(predicted_ltv_12m), 6) AS avg_predicted_ltv_12m, min(predicted_ltv_12m) AS min_predicted_ltv_12m, max(predicted_ltv_12m) AS max_predicted_ltv_12m"
ORACLE["get_customer_ltv_predictions"] = with_views(f"SELECT ltv_segment, {_LTV}, count(*) AS customer_count, {S}, 'customer_ltv_predictor' AS model_name FROM p_ltv GROUP BY 1")
QUERIES["get_vip_customers"] = lambda c: pf.get_vip_customers(ltv(c))
ORACLE["get_vip_customers"] = with_views(f"SELECT ltv_segment, count(*) AS vip_customer_count, {_LTV}, {S} FROM p_ltv WHERE ltv_segment = 'VIP' GROUP BY 1")
QUERIES["get_high_demand_properties"] = lambda c: pf.get_high_demand_properties(demand(c), 100)
ORACLE["get_high_demand_properties"] = with_views(f"""SELECT row_number() OVER (ORDER BY avg_predicted_bookings DESC, destination_id, property_type) AS rank, * FROM (SELECT destination_id, property_type, round(avg(predicted_bookings), 6) AS avg_predicted_bookings,
    max(predicted_bookings) AS max_predicted_bookings, count(*) AS property_count, {S} FROM p_demand GROUP BY 1, 2) QUALIFY rank <= 100""")
_SEGMENT = """CASE WHEN predicted_ltv_12m > 2500 AND total_bookings >= 5 THEN 'High-Value Customers' WHEN days_since_last_booking > 90 OR cancellation_rate > 0.3 THEN 'At-Risk Customers' WHEN total_bookings >= 3 AND is_repeat THEN 'Repeat Travelers'
    WHEN avg_booking_value < 200 THEN 'Price-Sensitive' WHEN total_bookings < 2 AND tenure_days < 30 THEN 'New Prospects' ELSE 'Standard Customers' END"""
QUERIES["get_customer_segment_distribution"] = lambda c: pf.get_customer_segment_distribution(ltv(c))
ORACLE["get_customer_segment_distribution"] = with_views("SELECT segment_name, CASE segment_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pf.SEGMENT_TEXT.items()) + f""" END AS segment_description, n AS customer_count,
    {dbl('round(n * 100.0 / sum(n) OVER (), 2)')} AS pct_of_total, round(a, 2) AS avg_ltv, round(b, 2) AS avg_total_bookings, round(s, 2) AS avg_total_spend, {S} FROM (SELECT {_SEGMENT} AS segment_name, count(*) AS n, round(avg(predicted_ltv_12m), 6) AS a,
    round(avg(total_bookings), 6) AS b, round(avg(total_spend), 6) AS s FROM p_ltv GROUP BY 1)""")
QUERIES["get_ml_predictions_summary"] = lambda c: pf.get_ml_predictions_summary(
    {"demand_predictor": demand(c), "conversion_predictor": conversion(c), "pricing_optimizer": pricing(c), "customer_ltv_predictor": ltv(c)})
ORACLE["get_ml_predictions_summary"] = with_views(" UNION ALL ".join(f"SELECT '{m}' AS model_name, count(*) AS prediction_count, DATE '{AS_OF}' AS latest_scoring_date, '{pf.MODEL_TEXT[m]}' AS description FROM {v}"
    for m, v in (("demand_predictor", "p_demand"), ("conversion_predictor", "p_conversion"), ("pricing_optimizer", "p_pricing"), ("customer_ltv_predictor", "p_ltv"))))

# --- promised by the documents ---------------------------------------------------------------------------------
QUERIES["get_high_conversion_properties"] = lambda c: pf.get_high_conversion_properties(conversion(c), 100)
ORACLE["get_high_conversion_properties"] = with_views(f"""SELECT row_number() OVER (ORDER BY conversion_probability DESC, property_id) AS rank, property_id, destination_id, property_type, conversion_probability, {S} FROM p_conversion QUALIFY rank <= 100""")
QUERIES["get_at_risk_customers"] = lambda c: pf.get_at_risk_customers(ltv(c))
ORACLE["get_at_risk_customers"] = with_views(f"SELECT user_id, predicted_ltv_12m, total_bookings, total_spend, {big('days_since_last_booking')} AS days_since_last_booking, cancellation_rate FROM p_ltv WHERE {_SEGMENT} = 'At-Risk Customers'")


def dated(c):
    return baseline.dated_demand(*t(c, "dim_property", "fact_booking_daily"), AS_OF)


add_view("p_dated", f"""SELECT property_id, destination_id, DATE '{AS_OF}' + CAST(k AS INTEGER) AS check_in_date, CAST(n AS DOUBLE) / span AS predicted_bookings FROM dim_property JOIN (SELECT property_id, sum(booking_count) AS n FROM fact_booking_daily GROUP BY 1) USING (property_id),
    (SELECT max(check_in_date) - min(check_in_date) + 1 AS span FROM fact_booking_daily), (SELECT unnest(range(1, 91)) AS k)""")
QUERIES["forecast_regional"] = lambda c: pf.forecast_regional(dated(c), c.table("dim_destination"))
ORACLE["forecast_regional"] = with_views("""SELECT destination_id, check_in_date, round(sum(predicted_bookings), 6) AS predicted_bookings, count(*) AS properties, any_value(destination) AS destination, any_value(country) AS country
    FROM p_dated JOIN dim_destination USING (destination_id) GROUP BY 1, 2""")
QUERIES["forecast_seasonality"] = lambda c: pf.forecast_seasonality(dated(c), c.table("dim_destination"))
ORACLE["forecast_seasonality"] = with_views(f"""SELECT destination_id, {big('month(check_in_date)')} AS month, round(avg(predicted_bookings), 6) AS avg_predicted_bookings, count(*) AS prediction_count, any_value(destination) AS destination
    FROM p_dated JOIN dim_destination USING (destination_id) GROUP BY 1, 2""")
