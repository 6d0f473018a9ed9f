import pytest
from pyspark.sql import functions as F

from innsight.operators import quality
from innsight.operators.quality import Rule
from innsight.plans import quality_reports, rules, silver

RULES = [Rule("t", "positive", "x > 0"), Rule("t", "named", "length(n) > 0"), Rule("t", "small", "x < 5", quality.WARNING)]


def data(spark):
    return spark.createDataFrame([(1, "a"), (9, "b"), (-1, "c"), (None, "d"), (2, None), (3, "")], "x int, n string")


def test_split_adds_up_and_null_fails(spark):
    valid, rejected = quality.split(data(spark), RULES)
    assert {r.x for r in valid.collect()} == {1, 9}
    assert valid.count() + rejected.count() == 6


def test_no_rules_means_no_quarantine(spark):
    valid, rejected = quality.split(data(spark), [])
    assert (valid.count(), rejected.count()) == (6, 0)


def test_violation_report_counts_null_as_violation(spark):
    got = {r.rule_name: r.violations for r in quality.violation_report(data(spark), RULES).collect()}
    assert got == {"positive": 2, "named": 2, "small": 2}


def test_quarantine_reason_is_first_match(spark):
    out = quality.quarantine(data(spark), RULES, [("x <= 0", "low"), ("n = ''", "blank")], "other")
    assert sorted((r.x or 0, r.quarantine_reason) for r in out.collect()) == [(-1, "low"), (0, "other"), (2, "other"), (3, "blank")]


def test_rule_table_round_trip(spark):
    listed = rules.build_rules(as_of="2001-01-01")
    assert len(listed) == 66
    assert (len(quality.critical(listed)), len(quality.warnings(listed))) == (49, 17)
    frame = quality.rules_frame(spark, listed)
    assert {r.name for r in quality.load_rules(frame, "silver_hosts", quality.CRITICAL)} == {"valid_host_id", "valid_email"}


def test_every_rule_parses(spark, catalog):
    for table in silver.BUILDERS:
        if table in ("property_amenities", "property_images"):
            continue
        listed = catalog.rules_for(table)
        assert listed
        assert quality.violation_report(catalog.derived(table), listed).count() == len(listed)


def test_diagnostics_split(spark):
    checks = [
        {"name": "n", "criticality": "error", "check": {"function": "is_not_null_and_not_empty", "arguments": {"column": "n"}}},
        {"name": "x", "criticality": "warn", "check": {"function": "is_between", "arguments": {"column": "x", "min_value": 1, "max_value": 5}}},
    ]
    valid, invalid = quality.split_diagnosed(quality.diagnose(data(spark), checks))
    assert (valid.count(), invalid.count()) == (4, 2)
    assert valid.where("size(_failures) = 1").count() == 3


def test_integrity_gate(spark):
    child = spark.createDataFrame([(i,) for i in range(12)], "k int")
    parent = spark.createDataFrame([(0,)], "k int")
    report = quality_reports.orphan_check("c", child, parent, "k")
    assert report.first().status == "FAIL"
    with pytest.raises(quality_reports.IntegrityError, match="c"):
        quality_reports.integrity_gate(report)
    assert quality_reports.orphan_check("c", child.where("k < 5"), parent, "k").first().status == "WARNING"
    assert quality_reports.orphan_check("c", child.limit(0), parent, "k").first().status == "PASS"


def test_silver_flags_are_two_valued(spark):
    df = spark.createDataFrame([(None, None, None)], "payment_id int, booking_id int, payment_method string").withColumn("status", F.lit(None).cast("string"))
    row = silver.payments(df).first()
    assert (row.is_completed, row.is_refund, row.is_digital_payment, row.is_card_payment) == (False,) * 4
    logs = spark.createDataFrame([("1", 1, None), ("2", 2, [])], "ticket_id string, user_id int, messages array<struct<sender:string,sentiment:string>>")
    assert [(r.message_count, r.has_messages, r.has_agent_reply) for r in silver.support_logs(logs).orderBy("ticket_id").collect()] == [(0, False, False)] * 2


def test_avg_price_falls_back_to_total(spark):
    df = spark.sql("SELECT 1 AS booking_id, DATE'2000-01-01' AS check_in, DATE'2000-01-01' AS check_out, CAST(50 AS DECIMAL(18,4)) AS total_amount")
    row = silver.bookings(df).first()
    assert row.nights_booked == 0 and float(row.avg_price_per_night) == 50.0
