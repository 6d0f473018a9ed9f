"""Config-driven alert rules over the modelled tables, compiled to one scan per table.

A rule names figures, says when it has something to report, and holds a message, a condition
column, an operator and a threshold. The figures of all rules wanted are conditional
aggregates: each source table is scanned once, grouped by day and listing at the same time,
and ends as one row. Conditions, texts and comparisons run on that one row. Dates are
explicit, so an evaluation can be repeated.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.functions.shared import current, mean
from innsight.operators.keys import upsert
from innsight.sources.storage import materialize

Tables = Callable[[str], DataFrame]

OPERATORS: dict[str, Callable[[Column, float], Column]] = {
    ">": lambda c, t: c > t,
    ">=": lambda c, t: c >= t,
    "<": lambda c, t: c < t,
    "<=": lambda c, t: c <= t,
    "=": lambda c, t: c == t,
    "==": lambda c, t: c == t,
    "!=": lambda c, t: c != t,
    "<>": lambda c, t: c != t,
}


@dataclass(frozen=True)
class AlertRule:
    """``columns``: name to SQL over figures and earlier columns; ``given``: when the rule has a row at all."""

    alert_id: str
    name: str
    domain: str
    severity: str
    columns: dict[str, str]
    column: str
    operator: str
    threshold: float
    given: str = "TRUE"
    enabled: bool = True
    tags: str = "{}"
    message: str = field(default="")


# --- figures: one scan per table -----------------------------------------------------------------

SUPERHOST_RATING = 4.8  # fixed value: rating from which a host counts as superhost
MIN_VIEWS = 10  # fixed value: weekly views below which a listing has low engagement
BY_DAY, BY_LISTING = 1, 2  # which grouping a row of a doubly grouped table belongs to


def _day(as_of: Column, back: int) -> Column:
    return F.date_sub(as_of, back)


class Scans:
    """The figures of one evaluation; ``asked`` names those that will be asked for.

    A grouped table that two scans use is written once, so that its source is scanned once. A
    table that none of the asked figures reads is neither built nor joined.
    """

    def __init__(self, tables: Tables, as_of: str, asked: set[str]):
        self.tables, self.as_of, self.asked, self.made = tables, F.lit(as_of).cast("date"), asked, {}
        self.need = {_SCAN_OF[name] for name in asked}

    def _once(self, name: str, df: Callable[[], DataFrame], readers: int) -> DataFrame:
        if name not in self.made:
            self.made[name] = materialize(df(), f"alert-{name}") if readers > 1 else df()
        return self.made[name]

    def _asked(self, figures: dict[str, Column]) -> list[Column]:
        return [how.alias(name) for name, how in figures.items() if name in self.asked]

    def _grouped(self, table: str, date: str, back: int, readers: int, **measures: Column) -> DataFrame:
        """A fact by day of the last ``back`` days, and by listing over all days, in one pass."""
        recent = F.when(F.col(date).between(_day(self.as_of, back), self.as_of), F.col(date))
        rows = lambda: self.tables(table).withColumn("_day", recent)
        return self._once(table, lambda: rows().groupingSets(
            [[F.col("_day")], [F.col("property_id")]], F.col("_day"), F.col("property_id")).agg(F.grouping_id().alias("_set"), *[m.alias(n) for n, m in measures.items()]), readers)

    def _bookings(self) -> DataFrame:
        since = lambda c: F.sum(F.when(F.col("check_in_date") >= _day(self.as_of, 30), F.col(c)))
        return self._grouped(
            "fact_booking_daily", "check_in_date", 30, ("bookings" in self.need) + bool(self.asked & SOLD), value=F.sum("total_booking_value"), n=F.sum("booking_count"), cancelled=F.sum("cancellation_count"),
            rate=mean("payment_completion_rate"), rows=F.count(F.lit(1)), avg_value=mean("avg_booking_value"), recent=since("booking_count"))

    def _views(self) -> DataFrame:
        week = F.col("engagement_date") >= _day(self.as_of, 7)
        return self._grouped(
            "fact_property_engagement", "engagement_date", 7, ("engagement" in self.need) + bool(self.asked & SEEN), views=F.sum("view_count"), users=F.sum("unique_user_views"), clicks=F.sum("click_count"),
            converted=F.sum("conversion_rate").cast("double"), measured=F.count("conversion_rate"), rows=F.count(F.lit(1)), weekly=F.sum(F.when(week, F.col("view_count"))))

    def _versions(self) -> DataFrame:
        """Every version of a listing with what its listing sold and showed, as far as a figure asks for it."""
        nothing = F.lit(None).cast("long")

        def build() -> DataFrame:
            out = self.tables("dim_property").select("property_id", "host_id", "base_price", "effective_from", "effective_to", "is_current")
            if self.asked & SOLD:
                sold = self._bookings().where(F.col("_set") == BY_LISTING).select("property_id", F.col("n").alias("sold"), F.col("recent").alias("sold_recently"))
                out = out.join(sold, "property_id", "left")
            else:
                out = out.withColumns({"sold": nothing, "sold_recently": nothing})
            if self.asked & SEEN:
                return out.join(self._views().where(F.col("_set") == BY_LISTING).select("property_id", "weekly"), "property_id", "left")
            return out.withColumn("weekly", nothing)

        joined = bool(self.asked & (SOLD | SEEN))
        return self._once("listing-versions", build, joined * (("listings" in self.need) + ("prices" in self.need) + bool(self.asked & LISTED)))

    def bookings(self) -> DataFrame:
        on = lambda back, c: F.sum(F.when(F.col("_day") == _day(self.as_of, back), F.col(c)))
        week = F.col("_day").between(_day(self.as_of, 8), _day(self.as_of, 2))
        return self._bookings().where((F.col("_set") == BY_DAY) & F.col("_day").isNotNull()).agg(
            F.coalesce(on(1, "value"), F.lit(0)).cast("double").alias("yesterday_revenue"), mean(F.when(week, F.col("value"))).alias("avg_7d_revenue"),
            on(1, "cancelled").alias("cancellations"), on(1, "n").alias("bookings"), F.coalesce(on(0, "n"), F.lit(0)).alias("today_bookings"), mean("n").alias("avg_bookings"),
            F.stddev("n").alias("stddev_bookings"), on(1, "rate").alias("payment"), F.coalesce(on(1, "rows"), F.lit(0)).alias("sellers"), on(1, "value").cast("double").alias("total_revenue"),
            on(1, "avg_value").alias("avg_booking_value"))

    def engagement(self) -> DataFrame:
        on = lambda back, c: F.sum(F.when(F.col("_day") == _day(self.as_of, back), F.col(c)))
        week = lambda c: F.sum(F.when(F.col("_day") < self.as_of, F.col(c)))
        return self._views().where((F.col("_set") == BY_DAY) & F.col("_day").isNotNull()).agg(
            F.coalesce(on(0, "views"), F.lit(0)).alias("today_views"), F.coalesce(on(1, "views"), F.lit(0)).alias("yesterday_views"),
            F.try_divide(on(1, "converted"), on(1, "measured")).alias("conversion"), F.coalesce(on(1, "rows"), F.lit(0)).alias("shown"), week("views").alias("total_views"),
            week("users").alias("unique_users"), week("clicks").alias("total_clicks"), F.round(F.try_divide(week("converted"), week("measured")), 2).alias("avg_conversion_rate"))

    def listings(self) -> DataFrame:
        """Listings open on a day are told from the validity of their versions."""
        open_at = lambda day: F.count_if((F.col("effective_from") <= day) & (F.col("effective_to").isNull() | (F.col("effective_to") > day)))
        none = lambda c, least: F.count_if(F.col("is_current") & (F.coalesce(c, F.lit(0)) < least))
        return self._versions().agg(*self._asked({
            "current_count": open_at(self.as_of), "last_week_count": open_at(_day(self.as_of, 7)), "low_engagement_count": none("weekly", MIN_VIEWS),
            "zero_booking_count": none("sold_recently", 1), "active_properties": F.count_if("is_current"), "avg_listing_price": F.round(mean(F.when(F.col("is_current"), F.col("base_price"))), 2)}))

    def prices(self) -> DataFrame:
        """Listings priced over three deviations from the mean; mean and deviation are scalars."""
        listed = self._versions().where("is_current AND base_price > 0").select(F.col("base_price").cast("double").alias("price"))
        marked = listed.withColumn("m", listed.agg(F.struct(F.avg("price").alias("mean"), F.stddev("price").alias("dev"))).scalar())
        return marked.where(F.abs(F.col("price") - F.col("m.mean")) > 3 * F.col("m.dev")).agg(F.count(F.lit(1)).alias("anomaly_count"), F.round(F.avg("price"), 2).alias("anomaly_price"))

    def hosts(self) -> DataFrame:
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        top = F.col("rating") >= SUPERHOST_RATING
        rated = current(self.tables("dim_host")).select("host_id", "rating", "is_verified")
        if self.asked & LISTED:
            own = self._versions().where("is_current").groupBy("host_id").agg(F.count(F.lit(1)).alias("listed"), total("sold").alias("sold"), total("sold_recently").alias("sold_recently"))
            rated = rated.join(own, "host_id", "left")
        figures = {
            "total_hosts": F.count(F.lit(1)), "superhosts": F.count_if(top), "verified_hosts": F.count_if("is_verified"), "avg_rating": F.round(mean("rating"), 2),
            "affected_hosts": F.count_if(F.col("rating") < 4.0), "superhost_properties": F.coalesce(F.sum(F.when(top, F.col("listed"))), F.lit(0)),
            "unverified_high_booking_count": F.count_if(~F.col("is_verified") & (F.col("sold") > 10)), "inactive_host_count": F.count_if(F.col("sold_recently") == 0)}
        return rated.agg(*self._asked(figures))

    def users(self) -> DataFrame:
        day, until = F.col("check_in_date"), F.col("check_in_date") <= self.as_of
        known = current(self.tables("dim_user")).select("user_id", "created_at", "user_type")
        if self.asked & SPENT:
            spent = self.tables("fact_booking_detail").where(until).groupBy("user_id").agg(
                F.sum("total_amount").alias("lifetime_value"), F.max(day).alias("last_booking_date"), F.count_if(day >= _day(self.as_of, 7)).alias("this_week"),
                F.count_if((day >= _day(self.as_of, 14)) & (day < _day(self.as_of, 7))).alias("last_week"))
            known = known.join(spent, "user_id", "left")
        business = F.col("user_type") == "business"
        since = lambda back: F.count_if(F.col("created_at") >= _day(self.as_of, back))
        return known.agg(*self._asked({
            "today_signups": F.count_if(F.col("created_at") == _day(self.as_of, 1)), "avg_daily_signups": since(30) / 30,
            "at_risk_vip_count": F.count_if((F.col("lifetime_value") > 1000) & (F.col("last_booking_date") < _day(self.as_of, 90))),
            "this_week_business": F.coalesce(F.sum(F.when(business, F.col("this_week"))), F.lit(0)), "last_week_business": F.coalesce(F.sum(F.when(business, F.col("last_week"))), F.lit(0)),
            "total_customers": F.count(F.lit(1)), "new_this_week": since(7), "business_customers": F.count_if(business), "avg_lifetime_value": F.round(mean("lifetime_value"), 2)}))


#: Which scan holds a figure.
FIGURES = {
    "bookings": "yesterday_revenue avg_7d_revenue cancellations bookings today_bookings avg_bookings stddev_bookings payment sellers total_revenue avg_booking_value",
    "engagement": "today_views yesterday_views conversion shown total_views unique_users total_clicks avg_conversion_rate",
    "listings": "current_count last_week_count low_engagement_count zero_booking_count active_properties avg_listing_price",
    "prices": "anomaly_count anomaly_price",
    "hosts": "total_hosts superhosts verified_hosts avg_rating affected_hosts superhost_properties unverified_high_booking_count inactive_host_count",
    "users": "today_signups avg_daily_signups at_risk_vip_count this_week_business last_week_business total_customers new_this_week business_customers avg_lifetime_value",
}
_SCAN_OF = {name: scan for scan, names in FIGURES.items() for name in names.split()}


#: Figures that read more than the dimension of their scan: bookings of a listing, its views, the listings of a host, the bookings of a user.
SOLD = {"zero_booking_count", "unverified_high_booking_count", "inactive_host_count"}
SEEN = {"low_engagement_count"}
LISTED = {"superhost_properties", "unverified_high_booking_count", "inactive_host_count"}
SPENT = {"at_risk_vip_count", "this_week_business", "last_week_business", "avg_lifetime_value"}


def _figures_of(rule: AlertRule) -> set[str]:
    words = set(re.findall(r"\w+", " ".join([rule.given, rule.message, *rule.columns.values()])))
    return words & set(_SCAN_OF)


def figures(rules: Sequence[AlertRule], tables: Tables, as_of: str) -> DataFrame:
    """One row with every figure that ``rules`` read."""
    scans = Scans(tables, as_of, set().union(*map(_figures_of, rules)))
    rows = {name: getattr(scans, name)() for name in FIGURES if name in scans.need}
    spark = next(iter(rows.values())).sparkSession
    one = spark.range(1).select(*[df.agg(F.first(F.struct(*df.columns))).scalar().alias(name) for name, df in rows.items()])
    return one.select(*[f"{name}.*" for name in rows])


def _said(message: str) -> Column:
    """The text of a message; {SQL} stands for a value."""
    parts = re.split(r"\{([^}]*)\}", message)
    return F.concat(*[F.expr(p).cast("string") if k % 2 else F.lit(p) for k, p in enumerate(parts) if p])


# --- rules -----------------------------------------------------------------------------------------

_DROP = "round(try_divide(CAST({0} - {1} AS DOUBLE), CAST({0} AS DOUBLE)) * 100, 1)"

# The 21 rules with their figures, conditions and message texts.
RULES: list[AlertRule] = [
    AlertRule(
        "REV-001-CRIT", "Revenue Drop Alert", "revenue", "CRITICAL",
        {"yesterday_revenue": "yesterday_revenue", "avg_7d_revenue": "avg_7d_revenue", "pct_change": "round((yesterday_revenue - avg_7d_revenue) / avg_7d_revenue * 100, 1)"},
        "pct_change", "<", -20, given="yesterday_revenue < avg_7d_revenue * 0.8",
        message="CRITICAL: Revenue dropped {-pct_change}% below 7-day average (${format_number(yesterday_revenue, 2)} vs avg ${format_number(avg_7d_revenue, 2)})"),
    AlertRule(
        "REV-002-CRIT", "High Cancellation Rate", "revenue", "CRITICAL",
        {"cancellations": "cancellations", "bookings": "bookings", "cancellation_rate": "round(try_divide(CAST(cancellations AS DOUBLE), CAST(bookings AS DOUBLE)) * 100, 1)"},
        "cancellation_rate", ">", 15, given="try_divide(CAST(cancellations AS DOUBLE), CAST(bookings AS DOUBLE)) > 0.15",
        message="CRITICAL: Cancellation rate at {cancellation_rate}% ({cancellations} of {bookings} bookings)"),
    AlertRule(
        "REV-003-WARN", "Booking Volume Anomaly", "revenue", "WARNING",
        {"today_bookings": "today_bookings", "avg_bookings": "avg_bookings", "stddev_bookings": "stddev_bookings", "z_score": "round(abs((today_bookings - avg_bookings) / stddev_bookings), 1)"},
        "z_score", ">", 2, given="stddev_bookings > 0 AND abs(today_bookings - avg_bookings) > 2 * stddev_bookings",  # both directions count
        message="WARNING: Booking volume anomaly - {today_bookings} bookings ({round((today_bookings - avg_bookings) / stddev_bookings, 1)} std deviations from 30-day mean of {CAST(round(avg_bookings, 0) AS BIGINT)})"),
    AlertRule(
        "REV-004-WARN", "Payment Completion Drop", "revenue", "WARNING", {"rate": "payment", "property_count": "sellers", "payment_rate": "round(payment, 1)"}, "payment_rate", "<", 90, given="payment < 90",
        message="WARNING: Payment completion rate at {round(payment, 1)}% (threshold: 90%)"),
    AlertRule(
        "REV-005-INFO", "Daily Revenue Summary", "revenue", "INFO",
        {"total_revenue": "total_revenue", "total_bookings": "bookings", "avg_booking_value": "avg_booking_value", "always_trigger": "1"}, "always_trigger", "=", 1,
        message="Daily Summary: ${format_number(total_revenue, 2)} revenue from {bookings} bookings (Avg: ${format_number(avg_booking_value, 2)})"),
    AlertRule(
        "ENG-001-CRIT", "Traffic Crash", "engagement", "CRITICAL",
        {"today_views": "today_views", "yesterday_views": "yesterday_views", "pct_drop": _DROP.format("yesterday_views", "today_views")}, "pct_drop", ">", 50,
        given="yesterday_views > 0 AND today_views < yesterday_views * 0.5", message="CRITICAL: Traffic down {pct_drop}% vs yesterday ({today_views} vs {yesterday_views} views)"),
    AlertRule(
        "ENG-002-WARN", "Conversion Rate Drop", "engagement", "WARNING", {"rate": "conversion", "property_count": "shown", "avg_conversion": "round(conversion, 2)"}, "avg_conversion", "<", 2,
        given="conversion < 2", message="WARNING: Conversion rate at {round(conversion, 2)}% (threshold: 2%)"),
    AlertRule(
        "ENG-003-WARN", "Low Engagement Properties", "engagement", "WARNING", {"low_engagement_count": "low_engagement_count"}, "low_engagement_count", ">", 0, given="low_engagement_count > 0",
        message="WARNING: {low_engagement_count} properties have <10 views in past 7 days"),
    AlertRule(
        "ENG-004-INFO", "Weekly Engagement Summary", "engagement", "INFO",
        {**{c: c for c in ("total_views", "unique_users", "total_clicks", "avg_conversion_rate")}, "always_trigger": "1"}, "always_trigger", "=", 1,
        message="Weekly Summary: {format_number(total_views, 0)} views, {format_number(unique_users, 0)} unique users, {avg_conversion_rate}% avg conversion"),
    AlertRule(
        "PROP-001-CRIT", "Inventory Drop", "property", "CRITICAL",
        {"current_count": "current_count", "last_week_count": "last_week_count", "pct_drop": _DROP.format("last_week_count", "current_count")}, "pct_drop", ">", 10,
        given="last_week_count > 0 AND current_count < last_week_count * 0.9", message="CRITICAL: Active listings dropped {pct_drop}% WoW ({current_count} vs {last_week_count})"),
    AlertRule(
        "PROP-002-WARN", "Price Anomaly", "property", "WARNING", {"anomaly_count": "anomaly_count", "avg_price": "anomaly_price"}, "anomaly_count", ">", 0, given="anomaly_count > 0",
        message="WARNING: {anomaly_count} properties have price anomalies (>3 std from mean of ${anomaly_price})"),
    AlertRule(
        "PROP-003-WARN", "Zero Booking Properties", "property", "WARNING", {"zero_booking_count": "zero_booking_count"}, "zero_booking_count", ">", 0, given="zero_booking_count > 0",
        message="WARNING: {zero_booking_count} active properties have had 0 bookings in past 30 days"),
    AlertRule(
        "PROP-004-INFO", "Property Portfolio Summary", "property", "INFO",
        {"active_properties": "active_properties", "superhost_properties": "superhost_properties", "avg_price": "avg_listing_price", "always_trigger": "1"}, "always_trigger", "=", 1,
        message="Portfolio Summary: {active_properties} active properties, {superhost_properties} superhost, avg ${avg_listing_price}/night"),
    AlertRule(
        "HOST-001-CRIT", "Host Rating Crash", "host", "CRITICAL", {"affected_hosts": "affected_hosts"}, "affected_hosts", ">", 0, given="affected_hosts > 0",
        message="CRITICAL: {affected_hosts} hosts are rated below 4.0"),
    AlertRule(
        "HOST-002-WARN", "Unverified Host with High Bookings", "host", "WARNING", {"unverified_high_booking_count": "unverified_high_booking_count"}, "unverified_high_booking_count", ">", 0,
        given="unverified_high_booking_count > 0", message="WARNING: {unverified_high_booking_count} unverified hosts have >10 bookings"),
    AlertRule(
        "HOST-003-WARN", "Inactive Host Alert", "host", "WARNING", {"inactive_host_count": "inactive_host_count"}, "inactive_host_count", ">", 5, given="inactive_host_count > 5",
        message="WARNING: {inactive_host_count} hosts have had no booking activity in past 30 days"),
    AlertRule(
        "HOST-004-INFO", "Host Performance Summary", "host", "INFO", {**{c: c for c in ("total_hosts", "superhosts", "verified_hosts", "avg_rating")}, "always_trigger": "1"}, "always_trigger", "=", 1,
        message="Host Summary: {total_hosts} total hosts, {superhosts} superhosts, {verified_hosts} verified, avg rating {avg_rating}"),
    AlertRule(
        "CUST-001-CRIT", "New Customer Drop", "customer", "CRITICAL",
        {"today_signups": "today_signups", "avg_daily_signups": "avg_daily_signups", "pct_below_avg": "round((avg_daily_signups - today_signups) / avg_daily_signups * 100, 1)"},
        "pct_below_avg", ">", 50, given="avg_daily_signups > 0 AND today_signups < avg_daily_signups * 0.5",
        message="CRITICAL: New signups at {today_signups} ({pct_below_avg}% below 30-day avg of {CAST(round(avg_daily_signups, 0) AS BIGINT)})"),
    AlertRule(
        "CUST-002-WARN", "High Value Customer Churn", "customer", "WARNING", {"at_risk_vip_count": "at_risk_vip_count"}, "at_risk_vip_count", ">", 0, given="at_risk_vip_count > 0",
        message="WARNING: {at_risk_vip_count} high-value customers have had no activity in 90+ days"),
    AlertRule(
        "CUST-003-WARN", "Business Customer Decline", "customer", "WARNING",
        {"this_week_business": "this_week_business", "last_week_business": "last_week_business", "pct_drop": _DROP.format("last_week_business", "this_week_business")}, "pct_drop", ">", 20,
        given="last_week_business > 0 AND this_week_business < last_week_business * 0.8",
        message="WARNING: Business bookings down {pct_drop}% WoW ({this_week_business} vs {last_week_business})"),
    AlertRule(
        "CUST-004-INFO", "Customer Growth Summary", "customer", "INFO",
        {**{c: c for c in ("total_customers", "new_this_week", "business_customers", "avg_lifetime_value")}, "always_trigger": "1"}, "always_trigger", "=", 1,
        message="Customer Summary: {total_customers} total, {new_this_week} new this week, avg LTV ${avg_lifetime_value}"),
]


def _told(one: DataFrame, rule: AlertRule) -> DataFrame:
    """The figures with the rule's columns and message, where it has something to report."""
    fresh = {name: F.expr(sql) for name, sql in rule.columns.items() if name != sql}
    return one.where(rule.given).withColumns(fresh).withColumn("alert_message", _said(rule.message))


def run_rule(rule: AlertRule, tables: Tables, as_of: str) -> DataFrame:
    return _told(figures([rule], tables, as_of), rule).select(*rule.columns, "alert_message")


def _verdict(rule: AlertRule) -> Column:
    """Status, value and message of a rule as one struct over the figures."""
    def inlined(sql: str) -> str:
        return re.sub(r"\w+", lambda w: f"({rule.columns[w[0]]})" if rule.columns.get(w[0], w[0]) != w[0] else w[0], sql)

    given = F.coalesce(F.expr(rule.given), F.lit(False))
    value = F.expr(inlined(rule.column)).cast("double")
    message = re.sub(r"\{([^}]*)\}", lambda m: "{" + inlined(m[1]) + "}", rule.message)
    hit = OPERATORS.get(rule.operator, OPERATORS[">"])(value, rule.threshold)
    return F.struct(
        F.lit(rule.alert_id).alias("alert_id"), F.lit(rule.domain).alias("domain"), F.lit(rule.severity).alias("severity"),
        F.when(~given, "EMPTY").when(hit, "TRIGGERED").otherwise("OK").alias("status"), F.when(given, value).alias("value"), F.when(given, _said(message)).alias("message"))


def evaluate(rules: Sequence[AlertRule], tables: Tables, as_of: str) -> DataFrame:
    """One row per enabled rule: TRIGGERED, OK, or EMPTY when it has nothing to report."""
    enabled = [r for r in rules if r.enabled]
    return figures(enabled, tables, as_of).select(F.inline(F.array(*[_verdict(r) for r in enabled])))


def low_engagement_properties(tables: Tables, as_of: Column, min_views: int = MIN_VIEWS) -> DataFrame:
    """Current listings below ``min_views`` in a week, one row each; a table because the list can be long."""
    views = tables("fact_property_engagement").where(F.col("engagement_date") >= _day(as_of, 7)).groupBy("property_id").agg(F.sum("view_count").alias("weekly_views"))
    return (
        current(tables("dim_property")).select("property_id").join(views, "property_id", "left")
        .withColumn("weekly_views", F.coalesce("weekly_views", F.lit(0))).where(F.col("weekly_views") < min_views)
    )


RULE_COLUMNS = "alert_id string, alert_name string, domain string, severity string, condition_column string, condition_operator string, condition_threshold double, is_enabled boolean, tags string"


def rules_table(spark: SparkSession, rules: Sequence[AlertRule] = RULES) -> DataFrame:
    return spark.createDataFrame(
        [(r.alert_id, r.name, r.domain, r.severity, r.column, r.operator, float(r.threshold), r.enabled, r.tags) for r in rules], RULE_COLUMNS
    )


def load_rules(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Idempotent load of the rule table: keyed on the alert id, every column updated."""
    return upsert(stored, incoming, ["alert_id"])
