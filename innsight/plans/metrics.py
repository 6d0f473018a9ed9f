"""Measure layer: named dimensions and measures over a star, queried by name.

A view has a base table, lookups (many-to-one joins that supply dimensions) and
rollups (one-to-many tables reduced to the join key before they join, so they never
multiply base rows). Measures are formulas over parts; parts are summed, formulas are
applied after grouping, so a ratio is a ratio of sums. A query plans only the joins
its fields touch.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Lookup:
    name: str
    table: str
    on: str  # base column
    key: str  # lookup column
    current_only: bool = False

    def frame(self, tables: Tables) -> DataFrame:
        df = tables(self.table)
        return df.where("is_current") if self.current_only else df


@dataclass(frozen=True)
class Rollup:
    """One-to-many table reduced to ``key``; ``under`` is reduced first and added to its rows."""

    name: str
    table: str
    key: str
    on: str  # column of the parent
    parts: dict[str, str]  # part -> aggregate SQL
    current_only: bool = False
    under: "Rollup | None" = None

    def frame(self, tables: Tables, wanted: set[str]) -> DataFrame:
        df = tables(self.table)
        if self.current_only:
            df = df.where("is_current")
        own = {p: e for p, e in self.parts.items() if p in wanted}
        if self.under is not None and wanted & self.under.all_parts():
            deeper = self.under.frame(tables, wanted)
            df = df.join(deeper.withColumnRenamed(self.under.key, "_under"), F.col(self.under.on) == F.col("_under"), "left")
            own.update({p: f"SUM({p})" for p in self.under.all_parts() & wanted})
        return df.groupBy(self.key).agg(*[F.expr(e).alias(p) for p, e in own.items()])

    def all_parts(self) -> set[str]:
        return set(self.parts) | (self.under.all_parts() if self.under else set())


@dataclass(frozen=True)
class Dimension:
    name: str
    of: str  # "source" or a lookup name
    expr: str  # over the columns of that table
    columns: tuple[str, ...]


def dim(name: str, of: str = "source", column: str | None = None) -> Dimension:
    return Dimension(name, of, column or name, (column or name,))


@dataclass(frozen=True)
class Measure:
    name: str
    formula: str  # over parts
    format: dict = field(default_factory=dict)


@dataclass(frozen=True)
class MetricView:
    name: str
    base: str
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    parts: dict[str, str]  # part -> row expression summed over base rows
    distinct_parts: dict[str, str] = field(default_factory=dict)  # part -> base column counted once
    lookups: tuple[Lookup, ...] = ()
    rollups: tuple[Rollup, ...] = ()
    current_only: bool = False

    def _pick(self, kind: str, items: Sequence, names: Sequence[str]) -> list:
        known = {i.name: i for i in items}
        missing = [n for n in names if n not in known]
        if missing:
            raise KeyError(f"{self.name} has no {kind} {', '.join(missing)}")
        return [known[n] for n in names]

    def query(
        self,
        tables: Tables,
        dims: Sequence[str | tuple[str, str]],
        measures: Sequence[str],
        where: str | None = None,
        having: str | None = None,
        order_by: Sequence[str] = (),
        limit: int | None = None,
        params: dict[str, str] | None = None,
    ) -> DataFrame:
        """Group by ``dims`` (names, or (alias, SQL over dimension names)) and compute ``measures``.

        ``order_by`` takes output names; a leading ``-`` sorts descending.
        """
        params = params or {}
        named = lambda text: [d.name for d in self.dimensions if re.search(rf"\b{d.name}\b", text)]
        outputs = [(d, d) if isinstance(d, str) else d for d in dims]
        self._pick("dimension", self.dimensions, [d for d in dims if isinstance(d, str)])
        needed = dict.fromkeys(n for _, text in outputs for n in named(text))
        needed.update(dict.fromkeys(named(where or "")))
        fields = self._pick("dimension", self.dimensions, list(needed))
        asked = self._pick("measure", self.measures, measures)

        in_formula = lambda p: any(re.search(rf"\b{p}\b", m.formula) for m in asked)
        row_parts = {p: e for p, e in self.parts.items() if in_formula(p)}
        once_parts = {p: c for p, c in self.distinct_parts.items() if in_formula(p)}
        rollups = [(r, {p for p in r.all_parts() if in_formula(p)}) for r in self.rollups]
        rollups = [(r, wanted) for r, wanted in rollups if wanted]
        lookups = [l for l in self.lookups if any(f.of == l.name for f in fields)]

        rows = tables(self.base)
        if self.current_only:
            rows = rows.where("is_current")
        summed = {p: F.expr(e) for p, e in row_parts.items()}
        for rollup, wanted in rollups:
            reduced = rollup.frame(tables, wanted).withColumnRenamed(rollup.key, "_many")
            rows = rows.join(reduced, F.col(rollup.on) == F.col("_many"), "left").drop("_many")
            summed.update({p: F.col(p) for p in wanted})

        # Reduce to the columns that dimensions and lookups read, then look up.
        keep = dict.fromkeys(
            [c for f in fields if f.of == "source" for c in f.columns] + [l.on for l in lookups] + list(once_parts.values())
        )
        reduced = rows.groupBy(*keep).agg(*[F.sum(e).alias(p) for p, e in summed.items()], F.count(F.lit(1)).alias("_rows"))
        reduced = reduced.alias("source")
        for lookup in lookups:
            reduced = reduced.join(
                lookup.frame(tables).alias(lookup.name), F.col(f"source.{lookup.on}") == F.col(f"{lookup.name}.{lookup.key}"), "left"
            )

        def dimension(f: Dimension) -> Column:
            text = f.expr.format(**params)
            for c in f.columns:
                text = re.sub(rf"\b{c}\b", f"{f.of}.{c}", text)
            return F.expr(text).alias(f.name)

        # Only dimensions are columns of their own here, so a condition can name nothing else.
        flat = reduced.select(
            *[dimension(f) for f in fields], F.struct(F.lit(1).alias("_"), *[F.col(f"source.{p}").alias(p) for p in summed]).alias("_parts"),
            F.struct(F.lit(1).alias("_"), *[F.col(f"source.{c}").alias(p) for p, c in once_parts.items()]).alias("_once"),
        )
        if where:
            flat = flat.where(where)
        grouped = flat.groupBy(*[F.expr(text).alias(alias) for alias, text in outputs]).agg(
            *[F.sum(f"_parts.{p}").alias(p) for p in summed], *[F.countDistinct(f"_once.{p}").alias(p) for p in once_parts],
            F.count(F.lit(1)).alias("_groups"),
        )
        out = grouped.select(
            *[alias for alias, _ in outputs],
            *[F.expr(m.formula).alias(m.name, metadata={"format": m.format} if m.format else {}) for m in asked],
        )
        if having:
            out = out.where(having)
        if order_by:
            out = out.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order_by])
        return out.limit(limit) if limit is not None else out


def _sum(part: str) -> str:
    return f"CAST({part} AS DOUBLE)"


def _div(a: str, b: str) -> str:
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def _pct(a: str, b: str) -> str:
    return f"{_div(a, b)} * 100"


# Display formats that travel with the measures as column metadata.
USD = {"type": "currency", "currency_code": "USD", "decimal_places": 2}
COUNT = {"type": "number", "abbreviation": "compact"}
PERCENT = {"type": "percentage", "decimal_places": 1}
NUMBER = {"type": "number", "decimal_places": 1}

REVENUE = MetricView(
    name="revenue",
    base="fact_booking_daily",
    lookups=(
        Lookup("dim_property", "dim_property", "property_id", "property_id", current_only=True),
        Lookup("dim_destination", "dim_destination", "destination_id", "destination_id"),
        Lookup("dim_date", "dim_date", "check_in_date", "date"),
    ),
    dimensions=(
        dim("check_in_date"), dim("property_id"), dim("property_title", "dim_property", "title"), dim("property_type", "dim_property"),
        dim("destination", "dim_destination"), dim("country", "dim_destination"), dim("month_name", "dim_date"), dim("year", "dim_date"),
    ),
    parts={
        "p_value": "total_booking_value", "p_count": "booking_count", "p_avg": "avg_booking_value", "p_days": "1L", "p_guests": "total_guests",
        "p_nights": "avg_nights_booked", "p_cancelled": "cancellation_count", "p_confirmed": "confirmed_booking_count", "p_paid": "payment_completion_rate",
    },
    distinct_parts={"p_properties": "property_id"},
    measures=(
        Measure("total_revenue", _sum("p_value"), USD),
        Measure("booking_count", "p_count", COUNT),
        Measure("avg_booking_value", _div("p_avg", "p_days"), USD),
        Measure("total_guests", "p_guests", COUNT),
        Measure("avg_nights", _div("p_nights", "p_days"), NUMBER),
        Measure("cancellation_count", "p_cancelled", COUNT),
        Measure("confirmed_count", "p_confirmed", COUNT),
        Measure("cancellation_rate", _pct("p_cancelled", "p_count"), PERCENT),
        Measure("payment_rate", _div("p_paid", "p_days"), PERCENT),
        Measure("property_count", "p_properties", COUNT),
    ),
)

ENGAGEMENT = MetricView(
    name="engagement",
    base="fact_property_engagement",
    lookups=(
        Lookup("dim_property", "dim_property", "property_id", "property_id", current_only=True),
        Lookup("dim_date", "dim_date", "engagement_date", "date"),
    ),
    dimensions=(
        dim("engagement_date"), dim("property_id"), dim("property_title", "dim_property", "title"), dim("property_type", "dim_property"),
        dim("destination_id", "dim_property"), dim("month_name", "dim_date"), dim("year", "dim_date"),
    ),
    parts={
        "p_views": "view_count", "p_viewers": "unique_user_views", "p_clicks": "click_count", "p_searches": "search_count",
        "p_conversion": "conversion_rate", "p_conversion_days": "CAST(conversion_rate IS NOT NULL AS BIGINT)",
        "p_time": "avg_time_on_page", "p_time_days": "CAST(avg_time_on_page IS NOT NULL AS BIGINT)",
    },
    measures=(
        Measure("total_views", "p_views", COUNT),
        Measure("unique_viewers", "p_viewers", COUNT),
        Measure("total_clicks", "p_clicks", COUNT),
        Measure("search_appearances", "p_searches", COUNT),
        Measure("avg_conversion_rate", _div("p_conversion", "p_conversion_days"), PERCENT),
        Measure("click_through_rate", _pct("p_clicks", "p_views"), PERCENT),
        Measure("avg_time_on_page", _div("p_time", "p_time_days"), NUMBER),
    ),
)

PROPERTY = MetricView(
    name="property",
    base="dim_property",
    current_only=True,
    lookups=(
        Lookup("dim_destination", "dim_destination", "destination_id", "destination_id"),
        Lookup("dim_host", "dim_host", "host_id", "host_id", current_only=True),
    ),
    rollups=(
        Rollup("fact_booking", "fact_booking_daily", "property_id", "property_id",
               {"p_value": "SUM(total_booking_value)", "p_count": "SUM(booking_count)"}),
    ),
    dimensions=(
        dim("property_id"), dim("property_title", column="title"), dim("property_type"), dim("base_price"), dim("bedrooms"), dim("max_guests"),
        dim("destination", "dim_destination"), dim("country", "dim_destination"), dim("host_name", "dim_host", "name"),
        dim("is_verified_host", "dim_host", "is_verified"),
    ),
    parts={"p_listings": "1L", "p_price": "base_price", "p_capacity": "max_guests", "p_bedrooms": "bedrooms"},
    measures=(
        Measure("property_count", "p_listings", COUNT),
        Measure("avg_base_price", _div("p_price", "p_listings"), USD),
        Measure("total_capacity", "p_capacity", COUNT),
        Measure("avg_bedrooms", _div("p_bedrooms", "p_listings"), NUMBER),
        Measure("total_revenue", _sum("p_value"), USD),
        Measure("booking_count", "p_count", COUNT),
        Measure("revenue_per_property", _div("p_value", "p_listings"), USD),
        Measure("bookings_per_property", _div("p_count", "p_listings"), NUMBER),
    ),
)

HOST = MetricView(
    name="host",
    base="dim_host",
    current_only=True,
    rollups=(
        Rollup(
            "dim_property", "dim_property", "host_id", "host_id", {"p_listings": "COUNT(1)"}, current_only=True,
            under=Rollup("fact_booking", "fact_booking_detail", "property_id", "property_id",
                         {"p_value": "SUM(total_amount)", "p_count": "COUNT(booking_id)"}),
        ),
    ),
    dimensions=(
        dim("host_id"), dim("host_name", column="name"), dim("is_verified"), dim("rating"), dim("country"), dim("is_active"), dim("joined_at"),
        Dimension("host_since_days", "source", "DATEDIFF({as_of}, joined_at)", ("joined_at",)),
    ),
    parts={
        "p_hosts": "1L", "p_verified": "CAST(COALESCE(is_verified, FALSE) AS BIGINT)", "p_rating": "rating",
        "p_rated": "CAST(rating IS NOT NULL AS BIGINT)",
    },
    measures=(
        Measure("host_count", "p_hosts", COUNT),
        Measure("verified_count", "p_verified", COUNT),
        Measure("avg_rating", _div("p_rating", "p_rated"), NUMBER),
        Measure("property_count", "COALESCE(p_listings, 0)", COUNT),
        Measure("total_revenue", _sum("p_value"), USD),
        Measure("booking_count", "COALESCE(p_count, 0)", COUNT),
        Measure("revenue_per_host", _div("p_value", "p_hosts"), USD),
        Measure("verification_rate", _pct("p_verified", "p_hosts"), PERCENT),
    ),
)

CUSTOMER = MetricView(
    name="customer",
    base="dim_user",
    current_only=True,
    rollups=(
        Rollup("fact_booking", "fact_booking_detail", "user_id", "user_id", {"p_value": "SUM(total_amount)", "p_count": "COUNT(booking_id)"}),
    ),
    dimensions=(
        dim("user_id"), dim("country"), dim("user_type"), dim("is_business"), dim("created_at"),
        Dimension("customer_tenure_days", "source", "DATEDIFF({as_of}, created_at)", ("created_at",)), dim("is_current"),
    ),
    parts={"p_users": "1L", "p_business": "CAST(COALESCE(is_business, FALSE) AS BIGINT)"},
    measures=(
        Measure("customer_count", "p_users", COUNT),
        Measure("business_count", "p_business", COUNT),
        Measure("booking_count", "COALESCE(p_count, 0)", COUNT),
        Measure("total_spend", _sum("p_value"), USD),
        Measure("avg_booking_value", _div("p_value", "p_count"), USD),
        Measure("bookings_per_customer", _div("COALESCE(p_count, 0)", "p_users"), NUMBER),
        Measure("spend_per_customer", _div("p_value", "p_users"), USD),
        Measure("business_rate", _pct("p_business", "p_users"), PERCENT),
    ),
)

VIEWS = {v.name: v for v in (REVENUE, ENGAGEMENT, PROPERTY, HOST, CUSTOMER)}

# Tenure cohorts.
TENURE_CUTS = [(30, "0-30 days"), (90, "30-90 days"), (180, "90-180 days"), (365, "180-365 days")]
TENURE_LAST = "1+ years"


def tenure_bucket(days: str) -> str:
    return "CASE " + " ".join(f"WHEN {days} < {cut} THEN '{name}'" for cut, name in TENURE_CUTS) + f" ELSE '{TENURE_LAST}' END"


def tenure_cohort(view: MetricView, tables: Tables, as_of: str, measures: Sequence[str]) -> DataFrame:
    days = "host_since_days" if view.name == "host" else "customer_tenure_days"
    return view.query(tables, [("tenure_bucket", tenure_bucket(days))], measures, params={"as_of": f"DATE'{as_of}'"})


def hot_destinations(tables: Tables, quantile: float = 0.9, limit: int | None = None) -> DataFrame:
    """Destinations in the top decile of both views and revenue.

    Both inputs are grouped to one row per destination; the thresholds are scalars.
    """
    views = ENGAGEMENT.query(tables, ["destination_id"], ["total_views"])
    revenue = REVENUE.query(tables, ["destination"], ["total_revenue"])
    cut_views = views.agg(F.percentile_approx("total_views", quantile)).scalar()
    cut_revenue = revenue.agg(F.percentile_approx("total_revenue", quantile)).scalar()
    named = views.join(tables("dim_destination").select("destination_id", "destination"), "destination_id")
    out = (
        named.where(F.col("total_views") >= cut_views)
        .join(revenue.where(F.col("total_revenue") >= cut_revenue), "destination")
        .select("destination", "total_views", "total_revenue")
        .orderBy(F.desc("total_views"), F.desc("total_revenue"))
    )
    return out if limit is None else out.limit(limit)


def overview(tables: Tables) -> DataFrame:
    """Headline measures of four views in one row, each view evaluated once."""
    heads = {
        "property": (PROPERTY, {"total_properties": "property_count"}),
        "host": (HOST, {"total_hosts": "host_count", "verification_rate": "verification_rate"}),
        "customer": (CUSTOMER, {"total_customers": "customer_count", "avg_ltv": "spend_per_customer"}),
    }
    row = REVENUE.query(tables, [], ["total_revenue", "booking_count", "avg_booking_value"]).select(
        "total_revenue", F.col("booking_count").alias("total_bookings"), F.col("avg_booking_value").alias("avg_booking")
    )
    for name, (view, fields) in heads.items():
        one = view.query(tables, [], list(fields.values()))
        row = row.withColumn(f"_{name}", one.select(F.struct(*[F.col(m).alias(a) for a, m in fields.items()])).scalar())
    return row.select(
        "total_revenue", "total_bookings", "avg_booking",
        *[F.col(f"_{name}.{a}").alias(a) for name, (_, fields) in heads.items() for a in fields],
    )
