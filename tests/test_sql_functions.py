import pytest

from innsight.functions import sql

RANGE = "'1995-01-01', '2001-12-31'"


@pytest.fixture(scope="module")
def functions(spark, catalog):
    return sql.register(spark, catalog.table)


def test_all_reports_are_registered(functions):
    assert len(sql.FUNCTIONS) == 36 and len(functions) == 27


def test_defaults_and_named_arguments(spark, functions):
    assert spark.sql(f"SELECT * FROM get_top_properties_by_revenue({RANGE})").count() == 10
    assert spark.sql(f"SELECT * FROM get_top_properties_by_revenue({RANGE}, top_n => 3)").count() == 3
    one = spark.sql(f"SELECT * FROM get_property_engagement({RANGE}, property_id_filter => 1)")
    assert one.where("property_id <> 1").count() == 0


def test_lateral_call_per_row(spark, functions):
    spark.sql("SELECT * FROM VALUES ('1996-01-01', '1996-12-31'), ('1997-01-01', '1997-12-31') AS r(a, b)").createOrReplaceTempView("spans")
    got = spark.sql("SELECT a, total_bookings FROM spans, LATERAL (SELECT sum(booking_count) AS total_bookings FROM get_payment_metrics(a, b))").collect()
    want = {
        y: spark.sql(f"SELECT count(*) FROM fact_booking_detail WHERE year(check_in_date) = {y}").first()[0] for y in (1996, 1997)
    }
    assert {int(r.a[:4]): r.total_bookings for r in got} == want


def test_top_n_keeps_few_rows_per_task(spark, functions):
    plan = spark.sql(f"SELECT * FROM get_customer_ltv({RANGE}, top_n => 5)")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan or "WindowGroupLimit" in plan


def test_prediction_functions_need_their_tables(spark, catalog, functions):
    assert "get_vip_customers" not in functions


def test_rank_is_a_top_k_for_any_size(spark, catalog):
    from innsight.functions import sql

    sql.register(spark, catalog.table)
    every = spark.sql("SELECT * FROM get_customer_ltv('1995-01-01', '2001-12-31', top_n => 5000)")
    # Beyond Spark's own limit for top-k windows, each part still keeps only its first rows.
    plan = every._jdf.queryExecution().optimizedPlan().toString()
    assert "_near" in plan and "<= 5000" in plan
    few = spark.sql("SELECT * FROM get_customer_ltv('1995-01-01', '2001-12-31', top_n => 7)").collect()
    assert [r["rank"] for r in few] == list(range(1, 8)) and sorted(map(str, every.where("rank <= 7").collect())) == sorted(map(str, few))
    assert spark.sql("SELECT * FROM get_revenue_by_destination('1995-01-01', '2001-12-31')").count() == (
        catalog.table("fact_booking_daily").select("destination_id").distinct().count())
