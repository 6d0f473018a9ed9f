"""Profile and drift metrics in long format.

A monitor lists aggregate metrics (SQL over rows), derived metrics (SQL over the
aggregates), slicing columns and, for time series, a date column with granularities.
The profile has one row per window, slice and metric; drift compares windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TABLE_SLICE = "all"


@dataclass(frozen=True)
class Monitor:
    name: str
    table: str
    aggregates: dict[str, str]
    derived: dict[str, str] = field(default_factory=dict)
    drift: dict[str, str] = field(default_factory=dict)  # drift metric -> profile metric it follows
    slices: tuple[str, ...] = ()
    time_column: str | None = None
    granularities: tuple[str, ...] = ("1 day", "1 week")


# The five monitors and their metric definitions.
REVENUE = Monitor(
    "revenue", "fact_booking_daily",
    {
        "daily_revenue": "SUM(total_booking_value)",
        "avg_booking_value": "try_divide(CAST(SUM(avg_booking_value) AS DOUBLE), COUNT(avg_booking_value))",
        "total_bookings": "SUM(booking_count)",
        "total_cancellations": "SUM(cancellation_count)",
    },
    {"cancellation_rate": "try_divide(total_cancellations, total_bookings) * 100"},
    {"revenue_vs_baseline": "daily_revenue"},
    ("destination_id", "property_id"), "check_in_date",
)
ENGAGEMENT = Monitor(
    "engagement", "fact_property_engagement",
    {
        "total_views": "SUM(view_count)",
        "total_clicks": "SUM(click_count)",
        "avg_conversion": "try_divide(CAST(SUM(conversion_rate) AS DOUBLE), COUNT(conversion_rate))",
    },
    {"engagement_health": "try_divide(total_clicks, total_views) * 100"},
    {}, ("property_id",), "engagement_date",
)
PROPERTY = Monitor(
    "property", "dim_property",
    {
        "active_listings": "COUNT_IF(is_current)",
        "avg_price": "try_divide(CAST(SUM(CASE WHEN is_current THEN base_price END) AS DOUBLE), COUNT_IF(is_current AND base_price IS NOT NULL))",
        "price_variance": "ROUND(STDDEV(CAST(base_price AS DOUBLE)), 4)",
    },
    {}, {}, ("property_type", "destination_id"),
)
HOST = Monitor(
    "host", "dim_host",
    {
        "active_hosts": "COUNT_IF(is_current AND is_active)",
        "total_current_hosts": "COUNT_IF(is_current)",
        "verified_hosts": "COUNT_IF(is_verified AND is_current)",
        "avg_rating": "try_divide(SUM(CASE WHEN is_current THEN rating END), COUNT_IF(is_current AND rating IS NOT NULL))",
    },
    {"verification_rate": "try_divide(verified_hosts, total_current_hosts) * 100"},
    {}, ("country", "is_verified"),
)
CUSTOMER = Monitor(
    "customer", "dim_user",
    {"total_customers": "COUNT_IF(is_current)", "business_customers": "COUNT_IF(is_business AND is_current)"},
    {"business_customer_rate": "try_divide(business_customers, total_customers) * 100"},
    {"customer_growth": "total_customers"}, ("country", "user_type"),
)
MONITORS = {m.name: m for m in (REVENUE, ENGAGEMENT, PROPERTY, HOST, CUSTOMER)}

_DAYS = {"1 day": 1, "1 week": 7}


def window_start(granularity: str, day: Column) -> Column:
    """Start of the fixed-length window holding ``day``, counted from 1970-01-01.

    These are the boundaries of ``window(ts, '1 week')``, as dates.
    """
    length = _DAYS[granularity]
    epoch = F.lit("1970-01-01").cast("date")
    return F.date_sub(day, F.pmod(F.datediff(day, epoch), F.lit(length)).cast("int"))


_WINDOW = ["window_start", "window_end", "granularity", "slice_key", "slice_value"]


def _windows(df: DataFrame, monitor: Monitor, snapshot_day: str | None) -> DataFrame:
    """One row per window and slice, metrics as columns.

    All granularities and slices are grouping sets of one scan; rows are added up in
    each task before they are shuffled.
    """
    if monitor.time_column:
        day = F.col(monitor.time_column)
        windows = {g: (window_start(g, day), _DAYS[g]) for g in monitor.granularities}
    else:
        windows = {"snapshot": (F.lit(snapshot_day).cast("date") if snapshot_day else F.current_date(), 0)}
    begins = {g: f"_begin_{k}" for k, g in enumerate(windows)}
    slices = {s: f"_slice_{k}" for k, s in enumerate(monitor.slices)}
    rows = df.withColumns({begins[g]: begin for g, (begin, _) in windows.items()} | {name: F.col(s).cast("string") for s, name in slices.items()})
    sets = [(g, s) for g in windows for s in (None, *monitor.slices)]
    columns = [*begins.values(), *slices.values()]
    grouped = rows.groupingSets([[begins[g], *([slices[s]] if s else [])] for g, s in sets], *columns).agg(
        F.grouping_id(*columns).alias("_set"), *[F.expr(e).cast("double").alias(n) for n, e in monitor.aggregates.items()]
    )
    # A column that a set does not group by has its bit set, the first column the highest.
    number = {(g, s): sum(1 << (len(columns) - 1 - k) for k, c in enumerate(columns) if c not in (begins[g], slices.get(s))) for g, s in sets}
    pick = lambda of: F.coalesce(*[F.when(F.col("_set") == n, of(g, s)) for (g, s), n in number.items()])
    return grouped.select(
        pick(lambda g, s: F.col(begins[g])).alias("window_start"), pick(lambda g, s: F.date_add(begins[g], windows[g][1])).alias("window_end"),
        pick(lambda g, s: F.lit(g)).alias("granularity"), pick(lambda g, s: F.lit(s or TABLE_SLICE)).alias("slice_key"),
        pick(lambda g, s: F.col(slices[s]) if s else F.lit(TABLE_SLICE)).alias("slice_value"), *monitor.aggregates,
    ).withColumns({n: F.expr(e) for n, e in monitor.derived.items()})


def profile(df: DataFrame, monitor: Monitor, snapshot_day: str | None = None) -> DataFrame:
    """Long metric table: window_start, window_end, granularity, slice_key, slice_value, metric, value."""
    return _windows(df, monitor, snapshot_day).unpivot(_WINDOW, [*monitor.aggregates, *monitor.derived], "metric", "value")


def profile_summary(df: DataFrame, monitor: Monitor, snapshot_day: str | None = None) -> DataFrame:
    """Windows, slice values and largest value of each granularity, slice and metric of the profile.

    The profile is summed up before it is made long, so a task hands on one row per granularity and
    slice. Every row of the table lies in a window of each granularity, so slice values are
    counted on the table itself, and not once per granularity and metric.
    """
    metrics = [*monitor.aggregates, *monitor.derived]
    found = _windows(df, monitor, snapshot_day).groupBy("granularity", "slice_key").agg(F.count(F.lit(1)).alias("windows"), *[F.max(m).alias(m) for m in metrics])
    named = [F.struct(F.lit(s or TABLE_SLICE).alias("slice_key"), (F.col(s).cast("string") if s else F.lit(TABLE_SLICE)).alias("slice_value")) for s in (None, *monitor.slices)]
    values = df.select(F.inline(F.array(*named))).distinct().groupBy("slice_key").agg(F.count("slice_value").alias("slices"))
    return found.join(values, "slice_key").unpivot(["granularity", "slice_key", "windows", "slices"], metrics, "metric", "largest").select(
        "granularity", "slice_key", "metric", "windows", "slices", "largest")


def _change(df: DataFrame, base: str) -> DataFrame:
    delta = F.col("value") - F.col(base)
    return df.withColumns({"drift_value": delta, "pct_change": F.try_divide(delta, F.col(base)) * 100})


def drift(profiled: DataFrame, monitor: Monitor) -> DataFrame:
    """Consecutive drift: each window against the window before, per slice.

    Groups hold one row per window, so their size is bounded by the calendar.
    """
    followed = {metric: name for name, metric in monitor.drift.items()}
    names = F.create_map(*[F.lit(x) for pair in followed.items() for x in pair])
    before = Window.partitionBy("granularity", "slice_key", "slice_value", "metric").orderBy("window_start")
    rows = profiled.where(F.col("metric").isin(*followed)).withColumn("base_value", F.lag("value").over(before))
    return _change(rows.where("base_value IS NOT NULL"), "base_value").select(
        "window_start", "window_end", "granularity", "slice_key", "slice_value", F.lit("CONSECUTIVE").alias("drift_type"),
        names[F.col("metric")].alias("drift_metric"), "value", "base_value", "drift_value", "pct_change",
    )


def baseline(profiled: DataFrame, as_of: str, first_days_back: int = 90, last_days_back: int = 30) -> DataFrame:
    """Mean of every metric over the frozen window [as_of-90, as_of-30]; summed as decimal, so row order cannot matter."""
    day = F.lit(as_of).cast("date")
    frozen = profiled.where(F.col("window_start").between(F.date_sub(day, first_days_back), F.date_sub(day, last_days_back)))
    return frozen.groupBy("granularity", "slice_key", "slice_value", "metric").agg(
        F.try_divide(F.sum(F.col("value").cast("decimal(28,6)")).cast("double"), F.count("value")).alias("base_value"),
        F.count("value").alias("base_windows"),
    )


def drift_from_baseline(profiled: DataFrame, frozen: DataFrame) -> DataFrame:
    keys = ["granularity", "slice_key", "slice_value", "metric"]
    return _change(profiled.join(frozen, keys), "base_value").withColumn("drift_type", F.lit("BASELINE"))


def column_profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """Default statistics of every column: rows, nulls, distinct, min, max, mean, stddev.

    One aggregate for the cheap statistics. Distinct counts come from a mergeable
    sketch; exact ones take a second scan, in which every column's values are reduced
    to distinct ones in each task before they are shuffled.
    """
    numeric = {"integer", "long", "double", "float", "decimal", "short", "byte"}
    stats, entries = [], []
    for f in df.schema.fields:
        c, is_num = F.col(f.name), f.dataType.typeName() in numeric
        number = c.cast("double")
        stats += [
            F.count_if(c.isNull()).alias(f"n_{f.name}"),
            F.approx_count_distinct(c).alias(f"d_{f.name}"),
            F.min(c).cast("string").alias(f"lo_{f.name}"),
            F.max(c).cast("string").alias(f"hi_{f.name}"),
            (F.round(F.avg(number), 4) if is_num else F.lit(None).cast("double")).alias(f"m_{f.name}"),
            (F.round(F.stddev(number), 4) if is_num else F.lit(None).cast("double")).alias(f"s_{f.name}"),
        ]
        entries.append(
            F.struct(
                F.lit(f.name).alias("column_name"), F.col(f"n_{f.name}").alias("null_count"), F.col(f"d_{f.name}").alias("distinct_count"),
                F.col(f"lo_{f.name}").alias("min"), F.col(f"hi_{f.name}").alias("max"), F.col(f"m_{f.name}").alias("mean"),
                F.col(f"s_{f.name}").alias("stddev"),
            )
        )
    out = df.agg(F.count(F.lit(1)).alias("row_count"), *stats).select("row_count", F.inline(F.array(*entries)))
    if not exact_distinct:
        return out
    values = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in df.columns])
    distinct = df.select(F.inline(values)).where("v IS NOT NULL").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))
    filled = F.coalesce("distinct_count", F.lit(0)).alias("distinct_count")
    return out.drop("distinct_count").join(distinct, "column_name", "left").select("row_count", "column_name", "null_count", filled, "min", "max", "mean", "stddev")


def pivot_latest(profiled: DataFrame, monitor: Monitor, as_of: str | None = None, days: int = 7) -> DataFrame:
    """Table-level metrics as columns, newest windows; the metric names are given, so no extra job finds them."""
    rows = profiled.where(F.col("slice_key") == TABLE_SLICE)
    if as_of:
        rows = rows.where(F.col("window_end") >= F.date_sub(F.lit(as_of).cast("date"), days))
    wide = rows.groupBy("window_start", "window_end", "granularity").pivot("metric", [*monitor.aggregates, *monitor.derived]).agg(F.max("value"))
    return wide.orderBy(F.desc("window_start"), "granularity")


def slice_rank(profiled: DataFrame, slice_key: str, metrics: Sequence[str], as_of: str | None = None, days: int = 7) -> DataFrame:
    rows = profiled.where((F.col("slice_key") == slice_key) & F.col("metric").isin(*metrics))
    if as_of:
        rows = rows.where(F.col("window_end") >= F.date_sub(F.lit(as_of).cast("date"), days))
    return rows.orderBy(F.desc("window_start"), F.desc("value"), "slice_value")


# Thresholds of the monitor alerts.
REVENUE_DROP_PCT, CANCELLATION_PCT, LOW_ENGAGEMENT_PCT = -20, 15, 5


def monitor_alerts(revenue_profile: DataFrame, engagement_profile: DataFrame) -> DataFrame:
    """Windows that break a threshold at table level."""
    table = F.col("slice_key") == TABLE_SLICE
    drops = drift(revenue_profile.where(table), REVENUE).where(F.col("pct_change") < REVENUE_DROP_PCT)
    cancels = revenue_profile.where(table & (F.col("metric") == "cancellation_rate") & (F.col("value") > CANCELLATION_PCT))
    quiet = engagement_profile.where(table & (F.col("metric") == "engagement_health") & (F.col("value") < LOW_ENGAGEMENT_PCT))
    shape = lambda df, name, value: df.select(F.lit(name).alias("alert_type"), F.col("window_end").alias("alert_time"), "granularity", F.col(value).alias("value"))
    return (
        shape(drops, "REVENUE_DROP", "pct_change")
        .unionByName(shape(cancels, "HIGH_CANCELLATION", "value"))
        .unionByName(shape(quiet, "LOW_ENGAGEMENT", "value"))
    )


def listing_changes(snapshots: DataFrame) -> DataFrame:
    """Listing count of each snapshot beside the one before (one row per snapshot)."""
    rows = snapshots.where((F.col("slice_key") == TABLE_SLICE) & (F.col("metric") == "active_listings"))
    before = F.lag("value").over(Window.partitionBy("slice_key").orderBy("window_start"))
    return rows.withColumn("previous_listings", before).select(
        F.lit("LISTING_DROP").alias("alert_type"), F.col("window_start").alias("alert_time"), F.col("value").alias("current_listings"),
        "previous_listings", (F.try_divide(F.col("value") - F.col("previous_listings"), F.col("previous_listings")) * 100).alias("pct_change"),
    )
