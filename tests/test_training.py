from innsight.plans import training
from registry import flows


def plan(df):
    return df._jdf.queryExecution().toString()


def test_many_rows_are_dealt_to_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_TASK", 50)
    dealt = training._dealt(spark.range(1000).coalesce(2), ["id"])
    assert dealt.rdd.getNumPartitions() == 20 and dealt.distinct().count() == 1000
    assert "Exchange" not in plan(training._dealt(spark.range(100).coalesce(2), ["id"]))


def test_a_file_read_by_one_of_many_tasks_is_dealt(spark, monkeypatch, folder):
    """One row group, cut into more tasks than its rows need: a single one of them gets the rows."""
    spark.range(100_000).coalesce(1).write.mode("overwrite").parquet(folder)
    monkeypatch.setattr(training, "ROWS_PER_TASK", 30_000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        df = spark.read.parquet(folder)
        assert df.rdd.getNumPartitions() >= 4
        assert max(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) == 100_000
        dealt = training._dealt(df, ["id"]).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(dealt) == 4 and max(dealt) < 30_000


def test_models_read_stored_rows(catalog):
    """Training, validation and scoring pass over one stored table, not over the joins behind it again."""
    for rows in (flows.demand_rows, flows.conversion_rows, flows.price_rows, flows.ltv_rows, flows.churn_rows):
        assert "Join" not in plan(rows(catalog)) and "Exchange" not in plan(rows(catalog))


def test_demand_rows_have_the_grain_of_the_fact(catalog):
    rows = flows.demand_rows(catalog)
    assert rows.count() == rows.select("property_id", "check_in_date").distinct().count() > 0
