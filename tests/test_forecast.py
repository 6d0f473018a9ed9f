import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from innsight.plans import forecast

START = dt.date(2000, 1, 1)


def series(spark, days, gaps=(), region=None):
    rows = [(START + dt.timedelta(d), 100.0 * math.exp(0.3 * math.sin(2 * math.pi * d / 365.25) + 0.2 * (d % 7 in (0, 1))) + d % 13, 1 + d % 5) for d in range(days) if d not in gaps]
    df = spark.createDataFrame(rows, "ds date, y double, booking_count int")
    return df if region is None else df.withColumn("region", F.lit(region))


def plain_fit(rows, terms):
    """The same fit by one dense matrix."""
    x, y = np.array([r.x for r in rows]), np.log1p([r.y for r in rows])
    penalty = forecast.PENALTY * np.diag(x.var(0) * (np.arange(len(terms)) > 0))
    return np.linalg.solve(x.T @ x / len(x) + penalty, x.T @ y / len(x))


def test_fit_from_moments_equals_one_matrix_and_counts_empty_days(spark):
    df = series(spark, 500, gaps=(7, 8, 300))
    days = forecast.filled(df)
    assert days.count() == 500 and days.where("y = 0").count() == 3
    got = forecast.fitted(forecast.moments(days, forecast.REVENUE), len(forecast.REVENUE)).first()
    rows = forecast.design(days, forecast.REVENUE).collect()
    assert np.allclose(got.beta, plain_fit(rows, forecast.REVENUE), atol=1e-6)
    residual = np.log1p([r.y for r in rows]) - np.array([r.x for r in rows]) @ got.beta
    assert math.isclose(got.sigma, float(np.sqrt((residual**2).mean())), rel_tol=1e-6)


def test_backtest_fits_are_the_forecasts_of_their_day(spark):
    df = series(spark, 520, gaps=(400,))
    fits = {r.cutoff: r for r in forecast.fold_fits(forecast.filled(df)).collect()}
    assert sorted(fits) == [START + dt.timedelta(d) for d in (365, 395, 425, 455, 485)]
    for cutoff in (min(fits), max(fits)):
        own = forecast.fitted(forecast.moments(forecast.filled(df.where(F.col("ds") <= cutoff)), forecast.REVENUE), len(forecast.REVENUE)).first()
        assert np.allclose(fits[cutoff].beta, own.beta, atol=1e-6) and math.isclose(fits[cutoff].sigma, own.sigma, rel_tol=1e-6)
    report = {r.cutoff: r for r in forecast.forecast_backtest(df).collect()}
    assert set(report) == set(fits) and all(r.n == 30 and 0 <= r.coverage <= 1 and r.wape >= 0 for r in report.values())
    assert forecast.forecast_backtest(df.where(F.col("ds") < "2000-06-01")).count() == 0


def test_regions_add_up_and_short_ones_follow_the_others(spark):
    df = series(spark, 420, region="a").union(series(spark, 420, region="b").withColumn("y", F.col("y") * 2)).union(
        series(spark, 420, region="new").where("ds >= DATE'2001-02-20'").withColumn("y", F.lit(3.0)))
    rows = forecast.forecast_regions(df, "region", 30).collect()
    assert len(rows) == 90
    by_day = {}
    for r in rows:
        by_day.setdefault(r.check_in_date, []).append(r)
    assert all(math.isclose(sum(r.predicted_bookings for r in day), day[0].total, rel_tol=1e-9) for day in by_day.values())
    assert all(r.predicted_bookings >= 0 for r in rows)
    own = {k: np.mean([r.own_fit for r in rows if r.region == k]) for k in ("a", "b", "new")}
    assert 1.5 < own["b"] / own["a"] < 2.5 and 3 < own["new"] < own["a"]
