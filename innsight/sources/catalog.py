"""Lazy catalog of landed, cleaned and modelled tables over one data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.operators import quality
from innsight.plans import gold, rules, silver
from innsight.sources import adapter
from innsight.sources.storage import materialize

# Tables that the reports read again and again, with the columns they filter on. Their plans end in a
# grouping by a unique key or in a join that adaptive execution splits, so no hot key makes a huge write
# task and they are written without a further shuffle.
STORED = {
    "dim_user": (),
    "dim_host": (),
    "dim_property": (),
    "dim_destination": (),
    "paid_bookings": (),
    "fact_booking_detail": ("check_in_date",),
    "fact_booking_daily": ("check_in_date",),
    "fact_property_engagement": ("engagement_date",),
    "fact_weather_daily": ("date",),
}


class Catalog:
    """Tables of one deployment.

    ``table(name)`` gives the modelled table; those in ``STORED`` are written once
    per session to the shared folder and read back, because every report starts from
    them. ``plan(name)`` gives the same table as an unwritten plan over the sources.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        min_date: str = "1990-01-01",
        as_of: str = "2001-08-02",
        calendar: tuple[str, str] = ("1995-01-01", "2005-12-31"),
    ):
        self.spark, self.root, self.as_of, self.calendar = spark, root.rstrip("/"), as_of, calendar
        self.rules = rules.build_rules(min_date=min_date, min_hire_date="1990-01-01", as_of=as_of)
        self.processed_at = F.lit(f"{as_of} 00:00:00").cast("timestamp_ntz")
        self._raw: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._raw[name]

    def source(self, name: str) -> DataFrame:
        return getattr(adapter, name)(self.raw)

    def rules_for(self, name: str) -> list[quality.Rule]:
        alias = {
            "support_logs": "customer_support_logs", "weather_forecasts": "forecast_daily_metric", "weather_history": "historical_daily_metric",
        }
        return rules.rules_for(self.rules, alias.get(name, name))

    def derived(self, name: str) -> DataFrame:
        """Source with derived columns, before any row is dropped."""
        return silver.BUILDERS[name](self.source(name), self.processed_at)

    def silver(self, name: str) -> DataFrame:
        return quality.keep_valid(self.derived(name), self.rules_for(name))

    def cleaned(self, name: str) -> DataFrame:
        """The cleaned table written once, for reports that read it several times."""
        return self.store(f"silver_{name}", lambda: self.silver(name))

    def quarantined(self, name: str) -> DataFrame:
        reasons = {"bookings": rules.BOOKING_REASONS, "payments": rules.PAYMENT_REASONS}[name]
        return quality.quarantine(self.source(name), self.rules_for(name), reasons, rules.OTHER_REASON)

    def plan(self, name: str, paid: DataFrame | None = None) -> DataFrame:
        """The table as a plan; ``paid`` replaces the paid bookings it would derive itself."""
        loaded = F.lit(self.as_of).cast("date")
        builders: dict[str, Callable[[], DataFrame]] = {
            "dim_user": lambda: gold.dim_user(self.silver("users"), loaded),
            "dim_host": lambda: gold.dim_host(self.silver("hosts"), loaded),
            "dim_property": lambda: gold.dim_property(self.silver("properties"), loaded),
            "dim_destination": lambda: gold.dim_destination(self.silver("destinations")),
            "dim_date": lambda: gold.dim_date(self.spark, *self.calendar),
            "paid_bookings": lambda: gold.paid_bookings(self.silver("bookings"), self.silver("payments")),
            "fact_booking_detail": lambda: gold.fact_booking_detail(
                paid if paid is not None else self.plan("paid_bookings"), self.silver("users"), self.silver("properties")
            ),
            "fact_booking_daily": lambda: gold.fact_booking_daily(
                paid if paid is not None else self.plan("paid_bookings"), self.silver("properties")
            ),
            "fact_property_engagement": lambda: gold.fact_property_engagement(
                self.silver("page_views"), self.silver("clickstream"), self.table("fact_booking_daily")
            ),
            "dim_weather_location": lambda: gold.dim_weather_location(
                self.source("weather_locations").withColumn("processed_timestamp", self.processed_at)
            ),
            "fact_weather_daily": lambda: gold.fact_weather_daily(self.silver("weather_forecasts")),
        }
        return builders[name]()

    def table(self, name: str) -> DataFrame:
        if name not in STORED:
            return self.plan(name)
        if name not in self._stored:
            paid = self.table("paid_bookings") if name.startswith("fact_booking_") else None
            self._stored[name] = materialize(self.plan(name, paid), name, STORED[name], rebalance=False)
        return self._stored[name]

    def store(self, name: str, build: Callable[[], DataFrame], rebalance: bool = True) -> DataFrame:
        """Write a further reusable table once (features, predictions) and read it back."""
        if name not in self._stored:
            self._stored[name] = materialize(build(), name, rebalance=rebalance)
        return self._stored[name]


_OPEN: dict[tuple[str, str], Catalog] = {}


def open_catalog(spark: SparkSession, root: str) -> Catalog:
    """Catalog of a folder, shared by all queries of one application."""
    key = (spark.sparkContext.applicationId, root.rstrip("/"))
    if key not in _OPEN:
        _OPEN[key] = Catalog(spark, root)
    found = _OPEN[key]
    if found.spark is not spark:
        found = _OPEN[key] = Catalog(spark, root)
    return found
