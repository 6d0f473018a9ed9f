"""Datasets behind the five dashboards (data only, no layout).

Facts are reduced to the joining key inside the date range before they meet a
dimension; distinct bookings are plain counts because the fact holds one row per
booking.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.functions.shared import bookings_by, bucket, count_sum, current, in_range, mean, percent, ratio, total

Tables = Callable[[str], DataFrame]


def _n() -> Column:
    return F.count(F.lit(1))


def _share(flag: str) -> Column:
    return percent(F.count_if(flag), _n())


def _detail(t: Tables, start: str, end: str) -> DataFrame:
    return t("fact_booking_detail").where(in_range("check_in_date", start, end))


def _engaged(t: Tables, start: str, end: str) -> DataFrame:
    return t("fact_property_engagement").where(in_range("engagement_date", start, end))


def _segment() -> Column:
    return F.when(F.col("is_business"), "Business").otherwise("Leisure").alias("segment")


def _users(t: Tables, *columns) -> DataFrame:
    return current(t("dim_user")).select("user_id", *columns)


def _month(column: str) -> Column:
    return F.date_trunc("month", F.col(column)).cast("date").alias("month")


def _best(df: DataFrame, n: int | None, *order) -> DataFrame:
    """Rows in order; only the first ``n`` of them unless ``n`` is None."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


# --- customer -----------------------------------------------------------------------------

def customer_kpis(t: Tables, start: str, end: str) -> DataFrame:
    return current(t("dim_user")).agg(_n().alias("total_customers"), _share("is_business").alias("business_pct"))


# Loyalty and frequency ranges.
LOYALTY_CUTS = [(2, "New (1 booking)"), (3, "Returning (2 bookings)"), (5, "Loyal (3-4 bookings)")]
LOYALTY_LAST = "VIP (5+ bookings)"
FREQUENCY_CUTS = [(2, "1 booking"), (3, "2 bookings"), (5, "3-4 bookings"), (10, "5-9 bookings")]
FREQUENCY_LAST = "10+ bookings"


def customer_segments(t: Tables, start: str, end: str) -> DataFrame:
    per_user = bookings_by(t("fact_booking_detail"), "user_id", start, end)
    return (
        per_user.groupBy(bucket(F.col("bookings"), LOYALTY_CUTS, LOYALTY_LAST).alias("segment"))
        .agg(_n().alias("customer_count"), total("revenue").alias("total_revenue"), ratio(F.sum("revenue"), _n()).alias("avg_spend_per_customer"))
        .orderBy(F.desc("total_revenue"))
    )


def business_vs_leisure(t: Tables, start: str, end: str) -> DataFrame:
    per_user = bookings_by(t("fact_booking_detail"), "user_id", start, end).join(_users(t, "is_business"), "user_id")
    n = F.sum("bookings")
    return per_user.groupBy(_segment()).agg(
        count_sum("bookings").alias("bookings"), total("revenue").alias("revenue"), ratio(F.sum("revenue"), n).alias("avg_booking_value"),
        ratio(F.sum("nights"), n).alias("avg_stay_length"),
    )


def customers_by_country(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    per_user = _users(t, "country").join(bookings_by(t("fact_booking_detail"), "user_id", start, end), "user_id", "left")
    rows = per_user.groupBy("country").agg(
        _n().alias("customer_count"), count_sum("bookings").alias("bookings"), total("revenue").alias("revenue")
    )
    return _best(rows, limit, F.desc_nulls_last("revenue"), "country")


def booking_frequency_distribution(t: Tables, start: str, end: str) -> DataFrame:
    per_user = bookings_by(t("fact_booking_detail"), "user_id", start, end)
    return (
        per_user.groupBy(bucket(F.col("bookings"), FREQUENCY_CUTS, FREQUENCY_LAST).alias("frequency_bucket"))
        .agg(_n().alias("customer_count")).orderBy(F.desc("customer_count"))
    )


def lead_time_by_segment(t: Tables, start: str, end: str) -> DataFrame:
    """Median from a mergeable sketch: exact while lead times have fewer distinct values than its accuracy."""
    lead = "days_between_booking_and_checkin"
    rows = _detail(t, start, end).select("user_id", lead).join(_users(t, "is_business"), "user_id")
    return rows.groupBy(_segment()).agg(mean(lead).alias("avg_lead_time"), F.percentile_approx(lead, 0.5).alias("median_lead_time"))


def top_customers_by_spend(t: Tables, start: str, end: str, limit: int | None = 20) -> DataFrame:
    per_user = bookings_by(t("fact_booking_detail"), "user_id", start, end).select(
        "user_id", F.col("bookings").alias("booking_count"), F.col("revenue").cast("double").alias("total_spend"),
        ratio("revenue", "bookings").alias("avg_booking_value"),
    )
    return _best(_users(t, "name", "country", "is_business").join(per_user, "user_id"), limit, F.desc("total_spend"), "user_id")


def new_vs_returning(t: Tables, start: str, end: str) -> DataFrame:
    """Customers per month whose first booking falls there, and those who booked before.

    Bookings are reduced to (customer, month) first; the first date per customer is a
    window over at most one row per month.
    """
    day = F.col("check_in_date")
    inside = in_range("check_in_date", start, end)
    per_month = t("fact_booking_detail").groupBy("user_id", _month("check_in_date")).agg(
        F.min(day).alias("earliest"), F.min(F.when(inside, day)).alias("first_in"), F.max(F.when(inside, day)).alias("last_in")
    )
    marked = per_month.withColumn("first_ever", F.min("earliest").over(Window.partitionBy("user_id"))).where("first_in IS NOT NULL")
    return marked.groupBy("month").agg(
        F.count_if(F.col("first_in") == F.col("first_ever")).alias("new_customers"),
        F.count_if(F.col("last_in") > F.col("first_ever")).alias("returning_customers"),
    ).orderBy("month")


def destination_preferences_by_segment(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    rows = (
        _detail(t, start, end).groupBy("user_id", "destination_id").agg(_n().alias("n"), F.sum("total_amount").alias("v"))
        .join(_users(t, "is_business"), "user_id")
        .groupBy(_segment(), "destination_id").agg(count_sum("n").alias("bookings"), total("v").alias("revenue"))
        .join(t("dim_destination").select("destination_id", "destination"), "destination_id")
        .select("segment", "destination", "bookings", "revenue")
    )
    return _best(rows, limit, "segment", F.desc("revenue"), "destination")


def user_type_filter_values(t: Tables, start: str, end: str) -> DataFrame:
    """Choices of the customer-type filter: 'All' and the types that occur."""
    kinds = current(t("dim_user")).select(F.when(F.col("is_business"), "Business").otherwise("Leisure").alias("user_type")).distinct()
    return _with_all(kinds, "user_type")


def _with_all(values: DataFrame, column: str) -> DataFrame:
    every = values.sparkSession.range(1).select(F.lit("All").alias(column))
    return every.unionByName(values).orderBy(column)


# --- engagement ---------------------------------------------------------------------------------

def engagement_kpis(t: Tables, start: str, end: str) -> DataFrame:
    return _engaged(t, start, end).agg(
        count_sum("view_count").alias("total_views"), count_sum("unique_user_views").alias("unique_users"),
        count_sum("click_count").alias("total_clicks"), mean("conversion_rate").alias("avg_conversion_rate"),
    )


def conversion_funnel(t: Tables, start: str, end: str) -> DataFrame:
    """Three stages from one scan."""
    one = _engaged(t, start, end).agg(*[count_sum(c).alias(c) for c in ("view_count", "click_count", "search_count")])
    stage = lambda name, order, c: F.struct(F.lit(name).alias("stage"), F.lit(order).alias("stage_order"), F.col(c).alias("count"))
    return one.select(F.inline(F.array(stage("Views", 1, "view_count"), stage("Clicks", 2, "click_count"), stage("Searches", 3, "search_count")))).orderBy("stage_order")


def engagement_trend(t: Tables, start: str, end: str) -> DataFrame:
    return _engaged(t, start, end).groupBy("engagement_date").agg(
        count_sum("view_count").alias("views"), count_sum("click_count").alias("clicks"), mean("conversion_rate").alias("conversion_rate")
    ).orderBy("engagement_date")


def _engagement_by_listing(t: Tables, start: str, end: str) -> DataFrame:
    per_property = _engaged(t, start, end).groupBy("property_id").agg(
        F.sum("view_count").alias("v"), F.sum("click_count").alias("c"), F.sum("conversion_rate").alias("cs"),
        F.count("conversion_rate").alias("cd"), F.sum("avg_time_on_page").alias("ts"), F.count("avg_time_on_page").alias("td"),
    )
    listings = current(t("dim_property")).select("property_id", "title", "property_type", "destination_id", "base_price")
    return per_property.join(listings, "property_id")


def _engagement_with_place(t: Tables, start: str, end: str) -> DataFrame:
    return _engagement_by_listing(t, start, end).join(t("dim_destination").select("destination_id", "destination", "country"), "destination_id")


def _conversion() -> Column:
    return ratio(F.sum("cs"), F.sum("cd"))


def conversion_by_property_type(t: Tables, start: str, end: str) -> DataFrame:
    return _engagement_by_listing(t, start, end).groupBy("property_type").agg(
        count_sum("v").alias("views"), count_sum("c").alias("clicks"), _conversion().alias("conversion_rate")
    ).orderBy(F.desc_nulls_last("conversion_rate"), "property_type")


def top_engaged_properties(t: Tables, start: str, end: str, limit: int | None = 20) -> DataFrame:
    rows = _engagement_with_place(t, start, end).groupBy(F.col("title").alias("property_title"), "destination").agg(
        count_sum("v").alias("total_views"), count_sum("c").alias("total_clicks"), _conversion().alias("avg_conversion_rate"),
        ratio(F.sum("ts"), F.sum("td")).alias("avg_time_on_page"),
    )
    return _best(rows, limit, F.desc("total_views"), "property_title", "destination")


def low_conversion_properties(t: Tables, start: str, end: str, min_views: int = 50, limit: int | None = None) -> DataFrame:
    rows = _engagement_with_place(t, start, end).groupBy(F.col("title").alias("property_title"), "destination", "base_price").agg(
        count_sum("v").alias("total_views"), _conversion().alias("avg_conversion_rate")
    )
    return _best(rows.where(F.col("total_views") >= min_views), limit, F.asc_nulls_first("avg_conversion_rate"), "property_title", "destination", "base_price")


def engagement_by_destination(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    rows = _engagement_with_place(t, start, end).groupBy("destination", "country").agg(
        count_sum("v").alias("total_views"), count_sum("c").alias("total_clicks"), _conversion().alias("avg_conversion_rate")
    )
    return _best(rows, limit, F.desc("total_views"), "destination")


def property_type_filter_values(t: Tables, start: str, end: str) -> DataFrame:
    return _with_all(current(t("dim_property")).select("property_type").distinct(), "property_type")


# --- host ------------------------------------------------------------------------------------------

def host_kpis(t: Tables, start: str, end: str) -> DataFrame:
    return current(t("dim_host")).agg(
        _n().alias("total_hosts"), _share("is_verified").alias("verified_pct"), mean("rating").alias("avg_rating"), _share("is_active").alias("active_pct")
    )


def host_rating_distribution(t: Tables, start: str, end: str) -> DataFrame:
    rated = current(t("dim_host")).where("is_active AND rating IS NOT NULL")
    return rated.groupBy((F.floor(F.col("rating") * 2) / 2).alias("rating_bucket")).agg(_n().alias("host_count")).orderBy("rating_bucket")


def _host_bookings(t: Tables, start: str, end: str) -> DataFrame:
    listed = current(t("dim_property")).select("host_id", "property_id").join(
        bookings_by(t("fact_booking_detail"), "property_id", start, end), "property_id", "left"
    )
    return listed.groupBy("host_id").agg(
        _n().alias("property_count"), count_sum("bookings").alias("booking_count"), F.sum("revenue").alias("revenue")
    )


def verification_impact(t: Tables, start: str, end: str) -> DataFrame:
    """Every host counts once in the mean rating, whatever its number of bookings."""
    hosts = current(t("dim_host")).join(_host_bookings(t, start, end), "host_id", "left")
    status = F.when(F.col("is_verified"), "Verified").otherwise("Not Verified").alias("status")
    return hosts.groupBy(status).agg(
        _n().alias("host_count"), mean("rating").alias("avg_rating"), F.coalesce(ratio(F.sum("revenue"), _n()), F.lit(0.0)).alias("revenue_per_host")
    )


def _hosts_with_listings(t: Tables, start: str, end: str) -> DataFrame:
    return current(t("dim_host")).select("host_id", "name", "country", "rating", "is_verified", "is_active").join(_host_bookings(t, start, end), "host_id")


def top_hosts_by_revenue(t: Tables, start: str, end: str, limit: int | None = 20) -> DataFrame:
    rows = _hosts_with_listings(t, start, end).withColumn("total_revenue", F.col("revenue").cast("double"))
    return _best(rows, limit, F.desc_nulls_last("total_revenue"), "host_id").drop("is_active", "revenue")


def top_hosts_by_rating(t: Tables, start: str, end: str, limit: int | None = 20) -> DataFrame:
    rows = _hosts_with_listings(t, start, end).where("is_active AND rating IS NOT NULL AND booking_count >= 5")
    return _best(rows, limit, F.desc("rating"), "host_id").drop("is_active", "revenue")


def hosts_by_country(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    rows = current(t("dim_host")).where("is_active").groupBy("country").agg(
        _n().alias("host_count"), mean("rating").alias("avg_rating"), _share("is_verified").alias("verified_pct")
    )
    return _best(rows, limit, F.desc("host_count"), "country")


def multi_property_hosts(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    rows = _hosts_with_listings(t, start, end).where("property_count > 1").withColumn(
        "total_revenue", F.coalesce(F.col("revenue").cast("double"), F.lit(0.0))
    )
    return _best(rows, limit, F.desc("property_count"), "host_id").drop("is_active", "revenue", "booking_count")


def country_filter_values(t: Tables, start: str, end: str) -> DataFrame:
    return _with_all(current(t("dim_host")).select("country").distinct(), "country")


# --- property ---------------------------------------------------------------------------------------

# Price ranges of the distribution chart.
PRICE_CUTS = [(100, "$0-100"), (200, "$100-200"), (300, "$200-300"), (500, "$300-500")]
PRICE_LAST = "$500+"


def portfolio_kpis(t: Tables, start: str, end: str) -> DataFrame:
    return current(t("dim_property")).agg(_n().alias("property_count"), count_sum("max_guests").alias("total_capacity"), mean("base_price").alias("avg_price"))


def properties_by_destination(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    rows = (
        current(t("dim_property")).groupBy("destination_id").agg(_n().alias("property_count"), mean("base_price").alias("avg_price"))
        .join(t("dim_destination").select("destination_id", "destination", "country"), "destination_id")
    )
    return _best(rows, limit, F.desc("property_count"), "destination").select("destination", "country", "property_count", "avg_price")


def price_distribution(t: Tables, start: str, end: str) -> DataFrame:
    return current(t("dim_property")).groupBy(bucket(F.col("base_price"), PRICE_CUTS, PRICE_LAST).alias("price_bucket")).agg(
        _n().alias("property_count")
    ).orderBy(F.desc("property_count"), "price_bucket")


def property_type_distribution(t: Tables, start: str, end: str) -> DataFrame:
    return current(t("dim_property")).groupBy("property_type").agg(
        _n().alias("property_count"), mean("base_price").alias("avg_price"), mean("bedrooms").alias("avg_bedrooms")
    ).orderBy(F.desc("property_count"), "property_type")


def _listing_bookings(t: Tables, start: str, end: str) -> DataFrame:
    sold = bookings_by(t("fact_booking_detail"), "property_id", start, end).select(
        "property_id", F.col("bookings").alias("booking_count"), F.col("revenue").cast("double").alias("total_revenue")
    )
    return current(t("dim_property")).select("property_id", "title", "property_type", "base_price", "destination_id").join(
        sold, "property_id", "left"
    ).withColumn("booking_count", F.coalesce("booking_count", F.lit(0)))


def _listing_bookings_with_place(t: Tables, start: str, end: str) -> DataFrame:
    return _listing_bookings(t, start, end).join(t("dim_destination").select("destination_id", "destination"), "destination_id").drop("destination_id")


def top_performing_properties(t: Tables, start: str, end: str, limit: int | None = 20) -> DataFrame:
    return _best(_listing_bookings_with_place(t, start, end), limit, F.desc_nulls_last("total_revenue"), "property_id")


def bottom_performing_properties(t: Tables, start: str, end: str, max_bookings: int = 5, limit: int | None = 20) -> DataFrame:
    rows = _listing_bookings_with_place(t, start, end).where(F.col("booking_count") <= max_bookings).withColumn(
        "total_revenue", F.coalesce("total_revenue", F.lit(0.0))
    )
    return _best(rows, limit, "total_revenue", "property_id")


def price_vs_performance(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    rows = _listing_bookings(t, start, end).withColumn("total_revenue", F.coalesce("total_revenue", F.lit(0.0)))
    return _best(rows, limit, "property_id").drop("destination_id")


def property_amenities_analysis(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    rows = current(t("dim_property")).groupBy("bedrooms", "bathrooms").agg(
        _n().alias("property_count"), mean("base_price").alias("avg_price"), mean("max_guests").alias("avg_capacity")
    )
    return _best(rows, limit, F.desc("property_count"), "bedrooms", "bathrooms")


def destination_filter_values(t: Tables, start: str, end: str) -> DataFrame:
    return _with_all(t("dim_destination").select("destination").distinct(), "destination")


# --- revenue ------------------------------------------------------------------------------------------

# Lead-time ranges in days.
LEAD_CUTS = [(7, "0-7 days"), (30, "7-30 days"), (90, "30-90 days")]
LEAD_LAST = "90+ days"


def executive_kpis(t: Tables, start: str, end: str) -> DataFrame:
    return _detail(t, start, end).agg(
        total("total_amount").alias("total_revenue"), _n().alias("booking_count"), mean("total_amount").alias("avg_booking_value"),
        _share("is_cancelled").alias("cancellation_rate"),
    )


def revenue_trend_monthly(t: Tables, start: str, end: str) -> DataFrame:
    return _detail(t, start, end).groupBy(_month("check_in_date")).agg(total("total_amount").alias("revenue"), _n().alias("bookings")).orderBy("month")


def revenue_by_destination(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    rows = bookings_by(t("fact_booking_detail"), "destination_id", start, end).join(
        t("dim_destination").select("destination_id", "destination", "country"), "destination_id"
    ).select("destination", "country", F.col("revenue").cast("double").alias("revenue"), "bookings")
    return _best(rows, limit, F.desc("revenue"), "destination")


def booking_funnel(t: Tables, start: str, end: str) -> DataFrame:
    """``confirmed_bookings`` counts all bookings, as the chart labels them."""
    status = F.col("status")
    return _detail(t, start, end).agg(
        _n().alias("confirmed_bookings"), F.count_if(status == "cancelled").alias("cancelled"), F.count_if(status == "completed").alias("completed")
    )


def cancellation_trend(t: Tables, start: str, end: str) -> DataFrame:
    return _detail(t, start, end).groupBy(_month("check_in_date")).agg(_share("is_cancelled").alias("cancellation_rate")).orderBy("month")


def revenue_by_property_type(t: Tables, start: str, end: str) -> DataFrame:
    per_property = bookings_by(t("fact_booking_detail"), "property_id", start, end)
    return (
        per_property.join(current(t("dim_property")).select("property_id", "property_type"), "property_id")
        .groupBy("property_type").agg(
            total("revenue").alias("revenue"), count_sum("bookings").alias("bookings"), ratio(F.sum("revenue"), F.sum("bookings")).alias("avg_booking_value")
        ).orderBy(F.desc("revenue"))
    )


def lead_time_distribution(t: Tables, start: str, end: str) -> DataFrame:
    lead = bucket(F.col("days_between_booking_and_checkin"), LEAD_CUTS, LEAD_LAST).alias("lead_time_bucket")
    return _detail(t, start, end).groupBy(lead).agg(_n().alias("booking_count"), total("total_amount").alias("revenue")).orderBy(F.desc("revenue"))


def booking_detail_table(t: Tables, start: str, end: str, limit: int | None = None) -> DataFrame:
    """Bookings whose references all resolve, the latest first.

    The references are semi-joined first so that a limit is applied before names
    and titles are fetched.
    """
    newest = _best(
        _detail(t, start, end)
        .join(_users(t), "user_id", "left_semi")
        .join(current(t("dim_property")).select("property_id"), "property_id", "left_semi")
        .join(t("dim_destination").select("destination_id"), "destination_id", "left_semi"),
        limit, F.desc("check_in_date"), "booking_id",
    )
    return (
        newest.join(_users(t, F.col("name").alias("customer_name")), "user_id")
        .join(current(t("dim_property")).select("property_id", F.col("title").alias("property_title")), "property_id")
        .join(t("dim_destination").select("destination_id", "destination"), "destination_id")
        .select("booking_id", "customer_name", "property_title", "destination", "check_in_date", "nights_booked", "total_amount", "status")
        .orderBy(F.desc("check_in_date"), "booking_id")
    )


DATASETS: dict[str, dict[str, Callable[[Tables, str, str], DataFrame]]] = {
    "customer": {
        f.__name__: f for f in (
            customer_kpis, customer_segments, business_vs_leisure, customers_by_country, booking_frequency_distribution, lead_time_by_segment,
            top_customers_by_spend, new_vs_returning, destination_preferences_by_segment, user_type_filter_values)
    },
    "engagement": {
        f.__name__: f for f in (
            engagement_kpis, conversion_funnel, engagement_trend, conversion_by_property_type, top_engaged_properties, low_conversion_properties,
            engagement_by_destination, property_type_filter_values)
    },
    "host": {
        f.__name__: f for f in (
            host_kpis, host_rating_distribution, verification_impact, top_hosts_by_revenue, top_hosts_by_rating, hosts_by_country,
            multi_property_hosts, country_filter_values)
    },
    "property": {
        f.__name__: f for f in (
            portfolio_kpis, properties_by_destination, price_distribution, property_type_distribution, top_performing_properties,
            bottom_performing_properties, price_vs_performance, property_amenities_analysis, destination_filter_values)
    },
    "revenue": {
        f.__name__: f for f in (
            executive_kpis, revenue_trend_monthly, revenue_by_destination, booking_funnel, cancellation_trend, revenue_by_property_type,
            lead_time_distribution, booking_detail_table, destination_filter_values)
    },
}
