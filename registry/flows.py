"""Streams and trained models."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from innsight.functions import predictions as pf
from innsight.operators import keys
from innsight.plans import evaluation, features, forecast, rules, silver, training
from innsight.sources.storage import scratch_path
from innsight.streaming import flows
from oracle.base import dbl, with_views
from registry import learning
from registry.cleaning import _BAD_BOOKINGS, _BOOKING_REASON, ORACLE as CLEANING
from registry.common import AS_OF

QUERIES: dict = {}
ORACLE: dict = {}


def landed(c, name: str, day: str):
    """A source table landed in three arrivals; rows without a date come with the last one."""
    frame = c.source(name)
    path = scratch_path(c.spark, f"landed-{name}")
    early, middle = F.col(day) < F.lit("1997-01-01").cast("date"), F.col(day) < F.lit("1999-06-01").cast("date")
    arrival = F.when(early, 0).when(middle, 1).otherwise(2)
    for number in range(3):
        frame.where(arrival == number).write.mode("append").parquet(path)
    return path, frame.schema


def source(c, name, day):
    path, schema = landed(c, name, day)
    return flows.stream_source(c.spark, path, schema, "*.parquet", files_per_batch=2)


def clean(c, name):
    return lambda df: silver.BUILDERS[name](df, c.processed_at)


def place(c, label):
    base = scratch_path(c.spark, label)
    return f"{base}/data", f"{base}/checkpoint"


def _stream_source(c):
    """Events as they are, appended to a table."""
    schema = c.raw("events").schema
    stream = flows.stream_source(c.spark, c.root, schema, "events.parquet")
    data, check = place(c, "events")
    stream.writeStream.format("parquet").option("path", data).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return c.spark.read.parquet(data).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_event"))


QUERIES["stream_source"] = _stream_source
ORACLE["stream_source"] = "SELECT event_type, count(*) AS events, max(event_id) AS last_event FROM events GROUP BY 1"


def _stream_silver(c):
    data, check = place(c, "silver")
    flows.run_silver(source(c, "bookings", "check_in"), clean(c, "bookings"), c.rules_for("bookings"), data, check)
    columns = "booking_id, user_id, property_id, check_in, check_out, total_amount, nights_booked, avg_price_per_night, is_long_stay, is_high_value, booking_business_key"
    return c.spark.read.parquet(data).selectExpr(*columns.split(", "))


QUERIES["stream_silver"] = _stream_silver
ORACLE["stream_silver"] = CLEANING["silver_bookings"]


def _stream_split(c):
    data, check = place(c, "split")
    flows.run_split(source(c, "bookings", "check_in"), clean(c, "bookings"), c.rules_for("bookings"), rules.BOOKING_REASONS, rules.OTHER_REASON,
                    f"{data}/valid", f"{data}/rejected", check)
    valid = c.spark.read.parquet(f"{data}/valid").select("booking_id", F.lit("valid").alias("outcome"))
    return valid.unionByName(c.spark.read.parquet(f"{data}/rejected").select("booking_id", F.col("quarantine_reason").alias("outcome")))


QUERIES["stream_split"] = _stream_split
ORACLE["stream_split"] = with_views(f"SELECT booking_id, 'valid' AS outcome FROM s_bookings UNION ALL SELECT booking_id, {_BOOKING_REASON} FROM {_BAD_BOOKINGS}")


def _newest():
    return [F.desc("updated_at"), F.desc("check_in"), F.desc("booking_update_id"), F.desc("property_id"), F.desc("status")]


def _stream_upsert(c):
    """Newest update per booking after three arrivals, then compacted."""
    data, check = place(c, "upsert")
    flows.run_upsert(source(c, "booking_updates", "updated_at"), clean(c, "booking_updates"), ["booking_id"], _newest, data, check, reduce_first=True)
    before = flows.current_rows(c.spark, data, ["booking_id"], _newest())
    kept = keys.grain_report(before, ["booking_id"]).first()
    assert kept.duplicated_keys == 0
    return flows.compact(c.spark, data, ["booking_id"], _newest()).select("booking_id", "booking_update_id", "status", "updated_at", "nights_booked")


QUERIES["stream_upsert"] = _stream_upsert
ORACLE["stream_upsert"] = with_views("""SELECT booking_id, booking_update_id, status, updated_at, check_out - check_in AS nights_booked FROM (SELECT *, row_number() OVER (PARTITION BY booking_id
    ORDER BY updated_at DESC, check_in DESC, booking_update_id DESC, property_id DESC, status DESC) AS rn FROM src_booking_updates) WHERE rn = 1""")


def _stream_metrics(c):
    data, check = place(c, "metrics")
    seen = flows.run_with_metrics(source(c, "bookings", "check_in"), clean(c, "bookings"), c.rules_for("bookings"), data, check, "booking_warnings")
    kept = c.spark.read.parquet(data).agg(F.count(F.lit(1)).alias("kept_rows"))
    names = ["rows_seen", "reasonable_guests", "reasonable_amount", "reasonable_stay"]
    return kept.withColumns({n: F.lit(sum(b[n] for b in seen)) for n in names})


QUERIES["stream_dq_metrics"] = _stream_metrics
ORACLE["stream_dq_metrics"] = with_views("""SELECT count(*) AS kept_rows, count(*) AS rows_seen, count(*) FILTER (guests_count NOT BETWEEN 1 AND 20) AS reasonable_guests,
    count(*) FILTER (total_amount NOT BETWEEN 10 AND 100000) AS reasonable_amount, count(*) FILTER (check_out - check_in NOT BETWEEN 1 AND 365) AS reasonable_stay FROM s_bookings""")

# --- trained models (rows only: tree ensembles have no SQL spelling) -----------------------------------
_FITTED: dict = {}


def stored_rows(c, spec, build, *keep):
    """What a model reads, written once: training, validation and scoring are many passes over it."""
    return c.store(f"training_{spec.name}", lambda: training.inputs_of(build(), spec, *keep), rebalance=False)


def fitted(c, spec, rows, split_key, *key):
    """Model and validation rows, trained once per application and folder; ``split_key`` and ``key`` tell rows apart."""
    name = (c.spark.sparkContext.applicationId, c.root, spec.name)
    if name not in _FITTED:
        past, held = training.split(rows(c), split_key)
        _FITTED[name] = (training.train(past, spec, (split_key, *key)), held)
    return _FITTED[name]


def demand_rows(c):
    """One row per listing and day, as the fact has."""
    return stored_rows(c, training.DEMAND, lambda: learning.demand_set(c), "property_id", "destination_id", "destination", "check_in_date")


def demand_model(c):
    return fitted(c, training.DEMAND, demand_rows, "property_id", "check_in_date")


def conversion_rows(c):
    labels = features.conversion_labels(c.table("fact_property_engagement"), c.table("fact_booking_detail"))
    columns = ("property_type", "destination_id", *training._LISTING)
    build = lambda: features.training_set(labels, [features.FeatureLookup(learning.property_features(c), ("property_id",), columns)])
    return stored_rows(c, training.CONVERSION, build, "property_id", "destination_id", "engagement_date")


def conversion_model(c):
    return fitted(c, training.CONVERSION, conversion_rows, "property_id", "engagement_date")


def price_rows(c):
    return stored_rows(c, training.PRICE, lambda: features.price_labels(c.table("fact_booking_daily")), "property_id", "check_in_date")


def price_model(c):
    return fitted(c, training.PRICE, price_rows, "property_id", "check_in_date")


def ltv_rows(c):
    """Features as known at the cutoff, value after it."""
    detail = c.table("fact_booking_detail")
    known = features.user_features(c.table("dim_user"), detail.where(F.col("created_at") <= F.lit(learning.CUTOFF).cast("date")), learning.CUTOFF)
    return stored_rows(c, training.LTV, lambda: features.ltv_labels(detail, learning.CUTOFF).join(known, "user_id"), "user_id")


def ltv_model(c):
    return fitted(c, training.LTV, ltv_rows, "user_id")


def churn_rows(c):
    build = lambda: features.churn_labels(learning.user_features(c), c.table("fact_booking_detail"), AS_OF)
    return stored_rows(c, training.CHURN, build, "user_id")


def churn_model(c):
    return fitted(c, training.CHURN, churn_rows, "user_id")


def regression(c, model, spec):
    trained, held = model(c)
    scored = training.predict(trained, held, spec).select(F.col(spec.label).alias("label"), "prediction")
    return evaluation.regression_metrics(scored).withColumn("model_name", F.lit(spec.name))


def classification(c, model, spec):
    trained, held = model(c)
    scored = training.predict(trained, held, spec).select(F.col(spec.label).alias("label"), F.col("prediction").alias("score"))
    return evaluation.classification_metrics(scored).withColumn("model_name", F.lit(spec.name))


QUERIES["train_demand"] = lambda c: regression(c, demand_model, training.DEMAND)
QUERIES["train_conversion"] = lambda c: classification(c, conversion_model, training.CONVERSION)
QUERIES["train_price"] = lambda c: regression(c, price_model, training.PRICE)
QUERIES["train_ltv"] = lambda c: regression(c, ltv_model, training.LTV)
QUERIES["train_churn"] = lambda c: classification(c, churn_model, training.CHURN)


def score(c, name):
    stamp = c.processed_at
    if name == "demand":
        return training.score_batch(demand_model(c)[0], demand_rows(c), training.DEMAND, ["property_id", "destination_id", "check_in_date"], AS_OF, stamp)
    if name == "conversion":
        return training.score_batch(conversion_model(c)[0], conversion_rows(c), training.CONVERSION, ["property_id", "destination_id", "property_type", "engagement_date"], AS_OF, stamp)
    if name == "pricing":
        rows = price_rows(c).select("property_id", "month", "quarter", "is_peak_season").distinct()
        return training.score_batch(price_model(c)[0], rows, training.PRICE, ["property_id", "month", "quarter", "is_peak_season"], AS_OF, stamp)
    return training.score_batch(ltv_model(c)[0], learning.user_features(c), training.LTV, ["user_id"], AS_OF, stamp)


for _name in ("demand", "conversion", "pricing", "ltv"):
    QUERIES["score_batch" if _name == "conversion" else f"score_batch_{_name}"] = lambda c, n=_name: score(c, n)
QUERIES["scored_pricing_summary"] = lambda c: pf.get_pricing_recommendations(score(c, "pricing"))
QUERIES["forecast_revenue"] = lambda c: forecast.forecast_revenue(learning.revenue_series(c), 90)
QUERIES["forecast_backtest"] = lambda c: forecast.forecast_backtest(learning.revenue_series(c))


# --- what SQL can say about trained models: which keys are scored, and how -------------------------------
def scored_keys(c, name, keys, value, low, high=None):
    """Keys of a scored table, and whether each value lies in its range."""
    v = F.col(value)
    fits = v.isNotNull() & ~F.isnan(v) & (v >= low) & (F.lit(True) if high is None else v <= high)
    return score(c, name).select(*keys, "model_name", "scoring_date", fits.alias("value_fits"))


LOWEST = -1e12
for _name, _keys, _value, _low, _high, _sql in (
    ("demand", ["property_id", "destination_id", "check_in_date"], "predicted_bookings", LOWEST, None,
     "SELECT DISTINCT f.property_id, p.destination_id, check_in_date, 'demand_predictor' AS model_name FROM fact_booking_daily f JOIN dim_property p ON p.property_id = f.property_id JOIN dim_destination d ON d.destination_id = p.destination_id"),
    ("conversion", ["property_id", "engagement_date"], "conversion_probability", 0.0, 1.0,
     "SELECT property_id, engagement_date, 'conversion_predictor' AS model_name FROM l_conversion"),
    ("pricing", ["property_id", "month", "quarter", "is_peak_season"], "recommended_price", LOWEST, None,
     "SELECT property_id, CAST(month AS DOUBLE) AS month, CAST(quarter AS DOUBLE) AS quarter, CAST(is_peak_season AS DOUBLE) AS is_peak_season, 'pricing_optimizer' AS model_name FROM p_pricing"),
    ("ltv", ["user_id"], "predicted_ltv_12m", LOWEST, None, "SELECT user_id, 'customer_ltv_predictor' AS model_name FROM dim_user"),
):
    QUERIES[f"scored_keys_{_name}"] = lambda c, a=(_name, _keys, _value, _low, _high): scored_keys(c, *a)
    ORACLE[f"scored_keys_{_name}"] = with_views(f"SELECT *, DATE '{AS_OF}' AS scoring_date, TRUE AS value_fits FROM ({_sql})")

QUERIES["scored_ltv_segments"] = lambda c: score(c, "ltv").select(
    "user_id", (F.col("ltv_segment") == F.expr("CASE WHEN predicted_ltv_12m >= 2500 THEN 'VIP' WHEN predicted_ltv_12m >= 1000 THEN 'High' WHEN predicted_ltv_12m >= 500 THEN 'Medium' ELSE 'Low' END")).alias("segment_fits"))
ORACLE["scored_ltv_segments"] = with_views("SELECT user_id, TRUE AS segment_fits FROM dim_user")
QUERIES["forecast_days"] = lambda c: forecast.forecast_revenue(learning.revenue_series(c), 90).select(
    "ds", ((F.col("yhat") > 0) & (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))).alias("band_fits"))
ORACLE["forecast_days"] = with_views("SELECT last + CAST(k AS INTEGER) AS ds, TRUE AS band_fits FROM (SELECT max(check_in_date) AS last FROM fact_booking_daily), (SELECT unnest(range(1, 91)) AS k)")

# The sums behind the fit: every product of two terms, over every day of the calendar.
QUERIES["forecast_moments"] = lambda c: forecast.moments(forecast.filled(learning.revenue_series(c)), forecast.REVENUE).select(
    F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.round("s", 2).alias("s"))
_T = "(ds - DATE '1970-01-01')"
_WAVES = [f"{fn}({_T} * {2 * math.pi * k / length!r})" for length, top in ((365.25, forecast.YEARLY_ORDER), (7.0, forecast.WEEKLY_ORDER)) for k in range(1, top + 1) for fn in ("sin", "cos")]
_DOW = "((dayofweek(ds) + 6) % 7)"
_X = ", ".join(f"({e})::DOUBLE" for e in ("1", f"{_T} / 365.25", *_WAVES, _DOW, f"CASE WHEN {_DOW} >= 5 THEN 1 ELSE 0 END", "coalesce(n, 0)", "ln(1 + coalesce(y, 0))"))
ORACLE["forecast_moments"] = with_views(f"""SELECT (i - 1)::BIGINT AS i, (j - 1)::BIGINT AS j, round(sum(z[i] * z[j]), 2) AS s FROM (SELECT [{_X}] AS z FROM
    (SELECT CAST(unnest(range(min(check_in_date), max(check_in_date) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS ds FROM fact_booking_daily)
    LEFT JOIN (SELECT check_in_date AS ds, CAST(sum(total_booking_value) AS DOUBLE) AS y, count(*) AS n FROM fact_booking_daily GROUP BY 1) USING (ds)),
    (SELECT unnest(range(1, {len(forecast.REVENUE) + 2})) AS i), (SELECT unnest(range(1, {len(forecast.REVENUE) + 2})) AS j) WHERE i <= j GROUP BY 1, 2""")


def regions(c):
    """Fitted bookings per destination and day, adding up to the fitted total."""
    daily = c.table("fact_booking_daily").groupBy("destination_id", F.col("check_in_date").alias("ds")).agg(F.sum("booking_count").cast("double").alias("y"), F.sum("booking_count").alias("booking_count"))
    return forecast.forecast_regions(daily.where("destination_id IS NOT NULL"), "destination_id")


QUERIES["forecast_regional_fitted"] = lambda c: pf.forecast_regional(regions(c), c.table("dim_destination"))
QUERIES["forecast_seasonality_fitted"] = lambda c: pf.forecast_seasonality(regions(c), c.table("dim_destination"))
QUERIES["forecast_regional_sums"] = lambda c: regions(c).groupBy("check_in_date").agg(
    F.count(F.lit(1)).alias("regions"), (F.abs(F.sum("predicted_bookings") - F.max("total")) < 1e-6).alias("adds_up"), (F.min("predicted_bookings") >= 0).alias("all_valid"))
ORACLE["forecast_regional_sums"] = with_views("""SELECT last + CAST(k AS INTEGER) AS check_in_date, n AS regions, TRUE AS adds_up, TRUE AS all_valid
    FROM (SELECT max(check_in_date) AS last, count(DISTINCT destination_id) AS n FROM fact_booking_daily), (SELECT unnest(range(1, 91)) AS k)""")
# How the backtest went, as far as SQL can say: its cutoffs and days, zero days included.
QUERIES["forecast_backtest_folds"] = lambda c: forecast.forecast_backtest(learning.revenue_series(c)).select("cutoff", "n", F.col("coverage").between(0, 1).alias("covered"))
ORACLE["forecast_backtest_folds"] = with_views("""SELECT first + 365 + CAST(30 * k AS INTEGER) AS cutoff, 30::BIGINT AS n, TRUE AS covered
    FROM (SELECT min(check_in_date) AS first, max(check_in_date) AS last FROM fact_booking_daily), (SELECT unnest(range(0, 2000)) AS k) WHERE first + 395 + CAST(30 * k AS INTEGER) <= last""")

# --- prediction reports over model output -----------------------------------------------------------------
_TYPED = ["property_id", "property_type"]
QUERIES["scored_demand_summary"] = lambda c: pf.get_demand_predictions(score(c, "demand").join(c.table("dim_property").select(*_TYPED), "property_id"))
QUERIES["scored_conversion_summary"] = lambda c: pf.get_conversion_predictions(score(c, "conversion"))
QUERIES["scored_ltv_summary"] = lambda c: pf.get_customer_ltv_predictions(score(c, "ltv"))
QUERIES["scored_vip_customers"] = lambda c: pf.get_vip_customers(score(c, "ltv"))
QUERIES["scored_high_demand"] = lambda c: pf.get_high_demand_properties(score(c, "demand").join(c.table("dim_property").select(*_TYPED), "property_id"), 100)


def _regional_errors(c):
    """Error of the demand model by destination, over the validation rows."""
    trained, held = demand_model(c)
    scored = training.predict(trained, held, training.DEMAND)
    error = F.col("prediction") - F.col(training.DEMAND.label)
    return scored.groupBy("destination").agg(
        F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.avg(error).alias("bias"))


QUERIES["demand_regional_errors"] = _regional_errors
