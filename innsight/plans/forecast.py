"""Daily forecasts by least squares on moments that add up.

A linear model of log(1 + y) on trend, Fourier terms and the calendar needs only sums of
products, X'X and X'y. Spark adds them per day, per fold and per region; a fit of any span is a
sum of parts. Forecast, backtest and regional forecasts share one fit, one penalty and one
interval. Days without a row count as zero.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.sources.storage import materialize

YEARLY_ORDER, WEEKLY_ORDER = 4, 2
FOURIER = tuple(f"{fn}_{name}_{k}" for name, top in (("year", YEARLY_ORDER), ("week", WEEKLY_ORDER)) for k in range(1, top + 1) for fn in ("sin", "cos"))
CALENDAR = ("one", "trend", *FOURIER, "day_of_week", "is_weekend")
REVENUE = (*CALENDAR, "booking_count")
PENALTY, SHRINK = 1e-3, 60.0  # share of the variance of a term; days that the pooled fit counts for
BAND = 1.2815515655446004  # fixed value: deviations of an 80 % interval of the normal distribution


def terms_of(day: str) -> dict[str, Column]:
    """Trend, Fourier terms and calendar of a date column."""
    t, weekday = F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).cast("double"), F.weekday(day)
    out = {"one": F.lit(1.0), "trend": t / 365.25, "day_of_week": weekday.cast("double"), "is_weekend": weekday.isin(5, 6).cast("double")}
    for name, length, top in (("year", 365.25, YEARLY_ORDER), ("week", 7.0, WEEKLY_ORDER)):
        for k in range(1, top + 1):
            angle = t * (2 * math.pi * k / length)
            out[f"sin_{name}_{k}"], out[f"cos_{name}_{k}"] = F.sin(angle), F.cos(angle)
    return out


def design(df: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``df`` with the array ``x`` of the terms of its ``ds``; a term that is no calendar term is a column of ``df``."""
    known = terms_of("ds")
    return df.withColumn("x", F.array(*[known[t] if t in known else F.col(t).cast("double") for t in terms]))


def filled(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, ds, y, booking_count) for every day from a group's first to the last of all; absent days are zero."""
    by, last = list(by), series.agg(F.max("ds")).scalar()
    first = series.groupBy(*by).agg(F.min("ds").alias("_first")) if by else series.agg(F.min("ds").alias("_first"))
    days = first.where("_first IS NOT NULL").select(*by, F.explode(F.sequence("_first", last)).alias("ds"))
    return days.join(series, [*by, "ds"], "left").select(*by, "ds", F.coalesce("y", F.lit(0.0)).alias("y"), F.coalesce("booking_count", F.lit(0)).alias("booking_count"))


def moments(days: DataFrame, terms: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, i, j, s): sums of products of the terms and, last, of log(1 + y), for i <= j."""
    p = len(terms)
    z = design(days, terms).select(*by, F.concat("x", F.array(F.log1p("y"))).alias("z"))
    pairs = F.expr(f"flatten(transform(sequence(0, {p}), i -> transform(sequence(i, {p}), j -> named_struct('i', i, 'j', j, 'v', z[i] * z[j]))))")
    return z.select(*by, F.inline(pairs)).groupBy(*by, "i", "j").agg(F.sum("v").alias("s"))


def fitted(sums: DataFrame, p: int, by: Sequence[str] = (), prior: Column | None = None) -> DataFrame:
    """(by, beta, sigma, means): one small solve per group, from its ``moments``.

    ``prior``: coefficients towards which a fit is drawn, as if by ``SHRINK`` more days; a group
    with few days follows them, one with many its own data. ``means`` are those of the terms.
    """
    packed = sums.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("i", "j", "s"))).alias("_m")) if by else sums.agg(F.array_sort(F.collect_list(F.struct("i", "j", "s"))).alias("_m"))
    packed = packed.where(F.size("_m") > 0).select(*by, F.col("_m.s").alias("_m"), (F.lit(None).cast("array<double>") if prior is None else prior).alias("_prior"))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(p + 1)
        for frame in frames:
            rows = []
            for values, towards in zip(frame["_m"], frame["_prior"]):
                m = np.zeros((p + 1, p + 1))
                m[upper] = values
                m = m + np.triu(m, 1).T
                n, xx, xy = m[0, 0], m[:p, :p], m[:p, p]
                spread = np.maximum(np.diag(xx) / n - (xx[0] / n) ** 2, 1e-12)
                spread[0] = 0.0  # the mean level is not penalised
                left, right = xx / n + PENALTY * np.diag(spread), xy / n
                if towards is not None:
                    pull = (SHRINK / n) * np.diag(np.where(np.arange(p) == 0, 1.0, spread))
                    left, right = left + pull, right + pull @ np.asarray(towards)
                beta = np.linalg.solve(left, right)
                rest = max(m[p, p] / n - 2 * beta @ xy / n + beta @ (xx / n) @ beta, 0.0)
                rows.append((beta.tolist(), math.sqrt(rest), (xx[0] / n).tolist()))
            out = frame[list(by)].copy()
            out["beta"], out["sigma"], out["means"] = [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]
            yield out

    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.select(*by).schema.fields)
    return packed.mapInPandas(solve, f"{names + ', ' if names else ''}beta array<double>, sigma double, means array<double>")


def value_at(beta: str | Column, x: str | Column) -> Column:
    """log(1 + y) of a design row."""
    return F.aggregate(F.zip_with(x, beta, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def _back(log_value: Column) -> Column:
    return F.greatest(F.expm1(log_value), F.lit(0.0))


def forecast_revenue(series: DataFrame, periods: int = 90) -> DataFrame:
    """Next ``periods`` days with an 80 % band; future booking counts are the mean of the past ones."""
    fit = fitted(moments(filled(series), REVENUE), len(REVENUE))
    last = series.agg(F.max("ds")).scalar()
    ahead = fit.select("*", F.explode(F.sequence(F.date_add(last, 1), F.date_add(last, periods))).alias("ds")).withColumn("booking_count", F.element_at("means", len(REVENUE)))
    rows = design(ahead, REVENUE).withColumn("h", value_at("beta", "x"))
    return rows.select("ds", _back(F.col("h")).alias("yhat"), _back(F.col("h") - BAND * F.col("sigma")).alias("yhat_lower"), _back(F.col("h") + BAND * F.col("sigma")).alias("yhat_upper"))


def fold_fits(days: DataFrame, initial: int = 365, period: int = 30, horizon: int = 30) -> DataFrame:
    """(k, cutoff, beta, sigma, means) of every cutoff: moments per period, added up along the folds."""
    span = days.agg(F.struct(F.min("ds").alias("first"), F.max("ds").alias("last"))).scalar()
    marked = days.withColumn("span", span)
    number = F.greatest(F.ceil((F.datediff("ds", "span.first") - initial) / period), F.lit(0)).cast("int")
    parts = moments(marked.withColumn("k", number), REVENUE, ["k"])
    # Every fold has all pairs, even one whose days were none of its own.
    folds = marked.select("span").limit(1).select("span", F.explode(F.sequence(F.lit(0), F.floor((F.datediff("span.last", "span.first") - initial - horizon) / period).cast("int"))).alias("k"))
    folds = folds.where(F.datediff("span.last", "span.first") >= initial + horizon).select("k", F.date_add("span.first", F.lit(initial) + F.col("k") * period).alias("cutoff"))
    so_far = Window.partitionBy("i", "j").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.withColumn("s", F.sum("s").over(so_far))
    return folds.join(fitted(summed, len(REVENUE), ["k"]), "k")


def forecast_backtest(series: DataFrame, initial: int = 365, period: int = 30, horizon: int = 30) -> DataFrame:
    """Rolling-origin evaluation of :func:`forecast_revenue`: the fit it would have made at each cutoff.

    Booking counts of the future are unknown at the cutoff, so their mean up to it is used.
    ``mape`` is over days with revenue, ``wape`` over all: absolute errors by revenue.
    """
    days = filled(series)
    fits = fold_fits(days, initial, period, horizon)
    span = F.explode(F.sequence(F.date_add("cutoff", 1), F.date_add("cutoff", horizon))).alias("ds")
    ahead = fits.select("cutoff", "beta", "sigma", F.element_at("means", len(REVENUE)).alias("booking_count"), span)
    rows = design(ahead, REVENUE).select("cutoff", "ds", "sigma", value_at("beta", "x").alias("h")).join(days.select("ds", "y"), "ds")
    error, width = F.abs(F.col("y") - _back(F.col("h"))), BAND * F.col("sigma")
    inside = F.col("y").between(_back(F.col("h") - width), _back(F.col("h") + width))
    return rows.groupBy("cutoff").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.try_divide(error, F.col("y"))).alias("mape"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(error).alias("mae"),
        F.avg(inside.cast("double")).alias("coverage"), F.try_divide(F.sum(error), F.sum("y")).alias("wape"))


def forecast_regions(series: DataFrame, region: str, periods: int = 90) -> DataFrame:
    """(region, check_in_date, predicted_bookings, own_fit, total): next ``periods`` days of every region, adding up to the total.

    Each region's fit is drawn towards the pooled fit of all; then a day's regions are scaled to
    the forecast of the total series, equally where all of them are zero.
    """
    days, p = filled(series, [region]), len(CALENDAR)
    sums = materialize(moments(days, CALENDAR, [region]), "region-moments")  # used by both fits
    pooled = fitted(sums.groupBy("i", "j").agg(F.sum("s").alias("s")), p)
    fits = fitted(sums, p, [region], pooled.select("beta").scalar())
    whole = filled(days.groupBy("ds").agg(F.sum("y").alias("y"), F.sum("booking_count").alias("booking_count")))
    total = fitted(moments(whole, CALENDAR), p)
    last = series.agg(F.max("ds")).scalar()
    ahead = lambda fit, *keep: design(fit.select(*keep, "beta", F.explode(F.sequence(F.date_add(last, 1), F.date_add(last, periods))).alias("ds")), CALENDAR).select(*keep, "ds", _back(value_at("beta", "x")).alias("y"))
    day = Window.partitionBy("ds")  # one row per region
    own = ahead(fits, region).withColumns({"_sum": F.sum("y").over(day), "_n": F.count(F.lit(1)).over(day)})
    share = F.when(F.col("_sum") > 0, F.col("y") / F.col("_sum")).otherwise(1 / F.col("_n"))
    return own.join(ahead(total).select("ds", F.col("y").alias("total")), "ds").select(
        region, F.col("ds").alias("check_in_date"), (share * F.col("total")).alias("predicted_bookings"), F.col("y").alias("own_fit"), "total")
