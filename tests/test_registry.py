import duckdb
import pytest

import __spark_entry__ as registry
from checks import TABLES, canonical

SAMPLE = [
    "silver_bookings", "quarantine_payments", "dq_referential_integrity", "fact_booking_daily", "scd2_user", "get_revenue_by_period", "get_host_performance",
    "mv_property", "monitor_drift", "alert_evaluate", "dash_customer_new_vs_returning", "features_user", "customer_segmentation", "stream_split",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return connection


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns[0] == "period_start" and df.count() > 0


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert len(registry.queries()) > 240


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, db, name):
    df = registry.queries()[name](spark, "/root/testdata/sf0.001")
    result = db.sql(registry.oracle_sql()[name])
    assert canonical(df.columns, df.collect()) == canonical(result.columns, result.fetchall())
