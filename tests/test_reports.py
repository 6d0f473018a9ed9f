import datetime as dt

import pytest
from pyspark.sql import functions as F

from innsight.functions import customer, engagement, host, property, revenue
from innsight.plans import alerts, dashboards, evaluation, features, gold, metrics, monitor


def test_calendar(spark):
    days = gold.dim_date(spark)
    assert days.count() == 4018 and len(days.columns) == 12
    row = days.where("date = DATE'2021-01-03'").first()
    assert (row.day_of_week, row.week_of_year, row.is_weekend, row.day_of_week_name) == (1, 53, True, "Sunday")


def test_latest_payment_counts_a_booking_once(catalog):
    daily, detail = catalog.table("fact_booking_daily"), catalog.table("fact_booking_detail")
    assert daily.agg(F.sum("booking_count")).first()[0] == detail.count()
    assert daily.where("payment_completion_rate > 100").count() == 0


def test_empty_range_gives_empty_reports_and_zero_rows(catalog):
    t = catalog.table
    args = ("1900-01-01", "1900-12-31")
    assert revenue.get_revenue_by_period(t("fact_booking_daily"), *args).count() == 0
    assert engagement.get_engagement_trends(t("fact_property_engagement"), *args).count() == 0
    rows = host.get_host_performance(t("dim_host"), t("dim_property"), t("fact_booking_detail"), *args)
    assert rows.count() == t("dim_host").count()
    assert rows.where("total_bookings <> 0 OR cancellation_rate IS NOT NULL").count() == 0
    segments = customer.get_customer_segments(t("dim_user"), t("fact_booking_detail"), *args).collect()
    assert [s.segment_name for s in segments] == ["Inactive"] and segments[0].segment_revenue_share is None


def test_optional_filters(catalog):
    t = catalog.table
    args = ("1995-01-01", "2001-12-31")
    every = property.get_property_performance(t("dim_property"), t("dim_destination"), t("fact_booking_detail"), t("fact_property_engagement"), *args)
    place = every.where("destination IS NOT NULL").first().destination
    some = property.get_property_performance(t("dim_property"), t("dim_destination"), t("fact_booking_detail"), t("fact_property_engagement"), *args, destination=place)
    assert sorted(map(tuple, some.collect()), key=str) == sorted(map(tuple, every.where(F.col("destination") == place).collect()), key=str)
    one = engagement.get_property_engagement(t("fact_property_engagement"), t("dim_property"), t("dim_destination"), *args, property_id=1)
    assert one.where("property_id <> 1").count() == 0


def test_default_top_n(catalog):
    t = catalog.table
    top = revenue.get_top_properties_by_revenue(t("fact_booking_daily"), t("dim_property"), t("dim_destination"), t("dim_host"), "1995-01-01", "2001-12-31")
    assert [r["rank"] for r in top.collect()] == list(range(1, 11))


def test_filters_reach_the_scan(catalog, capsys):
    df = revenue.get_payment_metrics(catalog.table("fact_booking_detail"), "1998-01-01", "1998-12-31")
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(check_in_date,1998-01-01)" in plan and "LessThanOrEqual(check_in_date,1998-12-31)" in plan
    assert "guests_count" not in plan.split("ReadSchema")[1].splitlines()[0]


def test_price_ranges_have_no_gaps(spark):
    from innsight.functions.shared import bucket

    df = spark.createDataFrame([(99.5,), (199.5,), (499.99,), (500.0,), (None,)], "p double")
    names = [r[0] for r in df.select(bucket(F.col("p"), property.PRICE_CUTS, property.PRICE_LAST)).collect()]
    assert names == ["$0-$99", "$100-$199", "$300-$499", "$500+", None]


# --- measure layer -----------------------------------------------------------------------

def test_view_sizes():
    assert sum(len(v.dimensions) for v in metrics.VIEWS.values()) == 40
    assert sum(len(v.measures) for v in metrics.VIEWS.values()) == 41


def test_only_needed_joins_are_planned(catalog):
    plain = metrics.REVENUE.query(catalog.table, ["check_in_date"], ["total_revenue"])
    assert "Join" not in plain._jdf.queryExecution().optimizedPlan().toString()
    placed = metrics.REVENUE.query(catalog.table, ["country"], ["total_revenue"])
    assert placed._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_one_to_many_does_not_weight_base_measures(catalog):
    with_facts = metrics.PROPERTY.query(catalog.table, [], ["avg_base_price", "total_revenue", "property_count"]).first()
    alone = metrics.PROPERTY.query(catalog.table, [], ["avg_base_price", "property_count"]).first()
    assert with_facts.avg_base_price == alone.avg_base_price and with_facts.property_count == alone.property_count


def test_unknown_fields_and_formats(catalog):
    with pytest.raises(KeyError, match="no measure nope"):
        metrics.HOST.query(catalog.table, [], ["nope"])
    df = metrics.HOST.query(catalog.table, [], ["total_revenue"])
    assert df.schema["total_revenue"].metadata["format"]["currency_code"] == "USD"


# --- monitors and alerts -------------------------------------------------------------------

def test_week_windows_match_the_window_function(spark):
    days = spark.range(40).select(F.date_add(F.lit("1999-12-20").cast("date"), F.col("id").cast("int")).alias("d"))
    both = days.select(
        monitor.window_start("1 week", F.col("d")).alias("a"),
        F.window(F.col("d").cast("timestamp"), "1 week").start.cast("date").alias("b"),
    )
    assert both.where("a <> b").count() == 0


def test_drift_needs_a_previous_window(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1), 10), (dt.date(2000, 1, 2), 15)], "check_in_date date, total_booking_value int").withColumns(
        {"avg_booking_value": F.lit(1), "booking_count": F.lit(0), "cancellation_count": F.lit(0), "destination_id": F.lit(1), "property_id": F.lit(1)}
    )
    profiled = monitor.profile(df, monitor.REVENUE)
    rows = monitor.drift(profiled, monitor.REVENUE).where("slice_key = 'all' AND granularity = '1 day'").collect()
    assert [(r.drift_value, r.pct_change) for r in rows] == [(5.0, 50.0)]
    assert profiled.where("metric = 'cancellation_rate' AND value IS NOT NULL").count() == 0


def test_inventory_drop_uses_validity(spark, catalog):
    rows = [(i, "2000-01-01", None) for i in range(8)] + [(100 + i, "2000-01-01", "2000-02-05") for i in range(2)]
    dim = spark.createDataFrame(rows, "property_id int, effective_from string, effective_to string").selectExpr(
        "property_id", "1L AS host_id", "5.0 AS base_price", "DATE(effective_from) AS effective_from", "DATE(effective_to) AS effective_to", "effective_to IS NULL AS is_current"
    )
    rule = next(r for r in alerts.RULES if r.alert_id == "PROP-001-CRIT")
    row = alerts.run_rule(rule, lambda name: dim if name == "dim_property" else catalog.table(name), "2000-02-06").first()
    assert (row.current_count, row.last_week_count, row.pct_drop) == (8, 10, 20.0)
    assert "20.0% WoW (8 vs 10)" in row.alert_message


def test_all_rules_together_say_what_each_says_alone(catalog):
    day = "2000-01-31"
    for r in alerts.evaluate(alerts.RULES, catalog.table, day).collect():
        rule = next(x for x in alerts.RULES if x.alert_id == r.alert_id)
        alone = alerts.run_rule(rule, catalog.table, day).first()
        assert r.status == ("EMPTY" if alone is None else r.status)
        if alone is not None:
            assert (r.value, r.message) == (float(alone[rule.column]), alone.alert_message)


def test_rules_scan_every_table_once(spark, catalog):
    reads = []

    def tables(name):
        reads.append(name)
        return catalog.table(name)

    out = alerts.evaluate(alerts.RULES, tables, "2001-08-02")
    assert sorted(reads) == sorted(set(reads)) and len(reads) == 6
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 10  # six sources, three of them as groups written once and read by several figures


def test_alert_rule_table():
    assert len(alerts.RULES) == 21
    assert {r.severity for r in alerts.RULES} == {"CRITICAL", "WARNING", "INFO"}


def test_disabled_rules_are_skipped(catalog):
    import dataclasses

    off = dataclasses.replace(alerts.RULES[4], enabled=False)
    out = alerts.evaluate([off, alerts.RULES[16]], catalog.table, "2001-08-02").collect()
    assert [r.alert_id for r in out] == ["HOST-004-INFO"] and out[0].status == "TRIGGERED"


def test_dashboards_are_complete():
    assert {k: len(v) for k, v in dashboards.DATASETS.items()} == {"customer": 10, "engagement": 8, "host": 8, "property": 9, "revenue": 9}


# --- learning --------------------------------------------------------------------------------

def test_auc_with_ties_and_missing_class(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "label int, score double")
    row = evaluation.classification_metrics(df).first()
    assert row.auc == pytest.approx((0.5 + 1 + 0 + 1) / 4)
    assert (row.precision, row.recall) == (0.5, 0.5)
    assert evaluation.classification_metrics(df.where("label = 1")).first().auc == 0.5


def test_mean_gap_equals_ordered_gaps(spark):
    days = ["2000-01-01", "2000-01-11", "2000-01-11", "2000-03-01"]
    detail = spark.createDataFrame([(1, i, d) for i, d in enumerate(days)], "user_id int, booking_id int, created_at string").withColumns(
        {"created_at": F.col("created_at").cast("date"), "total_amount": F.lit(1).cast("decimal(18,2)"), "is_cancelled": F.lit(False)}
    )
    users = spark.createDataFrame([(1, "x", "y", True, True)], "user_id int, country string, user_type string, is_business boolean, is_current boolean").withColumn(
        "created_at", F.lit("1999-01-01").cast("date")
    )
    row = features.user_features(users, detail, "2000-04-01").first()
    assert row.avg_days_between_bookings == pytest.approx((10 + 0 + 50) / 3) and row.is_repeat


def test_codes_are_stored_and_unknowns_marked(spark):
    codes = features.category_codes(spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string"), "c")
    out = features.encode(spark.createDataFrame([("a",), ("zzz",), (None,)], "c string"), "c", codes, "code")
    assert {(r.c, r.code) for r in out.collect()} == {("a", 0), ("zzz", -1), (None, -1)}


def test_signature_defaults_and_clipping(spark):
    df = spark.createDataFrame([("12.5", 99999999999, None)], "a string, b long, c string")
    row = features.conform_signature(df, [("b", "integer"), ("a", "double"), ("c", "boolean"), ("new", "long")]).first()
    assert tuple(row) == (2147483647, 12.5, False, 0)


def test_later_rows_change_no_feature(catalog):
    from datetime import date

    day = "2000-01-31"
    tables = [catalog.table(n) for n in ("dim_property", "fact_booking_daily", "fact_property_engagement")]
    want = sorted(map(str, features.property_features(*tables, day).collect()))
    until = lambda df, c: df.where(F.col(c) <= F.lit(date(2000, 1, 31)))
    got = features.property_features(tables[0], until(tables[1], "check_in_date"), until(tables[2], "engagement_date"), day).collect()
    assert tables[1].where(F.col("check_in_date") > F.lit(date(2000, 1, 31))).count() > 0
    assert sorted(map(str, got)) == want


def test_trees_take_many_categories(spark):
    from innsight.plans import training

    spec = training.DEMAND
    names = [*spec.numeric, *spec.categorical]
    rows = spark.range(400).select(*[(F.concat(F.lit("c"), F.col("id") % 40) if n in spec.categorical else (F.col("id") % 7)).alias(n) for n in names], (F.col("id") % 5).alias(spec.label))
    model = training.train(rows, spec)
    assert training.predict(model, rows, spec).count() == 400
    assert len(training.feature_importance(model, spec)) == len(names)


def test_a_condition_keeps_its_literals(catalog):
    name = metrics.REVENUE.measures[0].name
    rows = metrics.REVENUE.query(catalog.table, ["destination"], [name], where="destination <> 'destination'")
    assert rows.count() == metrics.REVENUE.query(catalog.table, ["destination"], [name]).where("destination IS NOT NULL").count()
    assert metrics.REVENUE.query(catalog.table, ["destination"], [name], where="destination = 'destination'").count() == 0
