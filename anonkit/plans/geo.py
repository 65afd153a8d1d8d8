"""Questions to ``view_geo_analysis`` (one row per order)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anonkit.functions import money
from anonkit.operators.collation import collated, spelling

_VALUE = "order_value"


def _month() -> Column:
    # from the date: a time of day may not exist in the zone of the session
    return F.date_format(F.col("order_date").cast("date"), "yyyy-MM").alias("month")


def orders_per_payment(view: DataFrame) -> DataFrame:
    return (
        view.groupBy("payment_method").agg(F.count("*").alias("orders")).orderBy(F.desc("orders"), "payment_method")
    )


def average_per_device(view: DataFrame) -> DataFrame:
    return (
        view.groupBy("device_type")
        .agg(money.mean(F.col(_VALUE)).alias("avg_order_value"))
        .orderBy(F.desc("avg_order_value"), "device_type")
    )


def orders_in_country(view: DataFrame, country: str = "Spain") -> DataFrame:
    return view.where(F.col("country") == country).groupBy("country").agg(F.count("*").alias("orders"))


def top_countries(view: DataFrame, top: int = 5) -> DataFrame:
    per_country = view.groupBy("country").agg(F.count("*").alias("orders"))
    return (
        per_country.select(F.rank().over(Window.orderBy(F.desc("orders"))).alias("ranking"), "country", "orders")
        .orderBy(F.desc("orders"), "country")
        .limit(top)
    )


def orders_by_device_in_country(view: DataFrame, country: str = "United Kingdom", device: str = "mobile") -> DataFrame:
    return (
        view.where((F.col("country") == country) & (F.col("device_type") == device))
        .groupBy("country", "device_type")
        .agg(F.count("*").alias("orders"))
    )


def top_payment_country(view: DataFrame, top: int = 3) -> DataFrame:
    return (
        view.groupBy("payment_method", "country")
        .agg(money.total(F.col(_VALUE)).alias("revenue"))
        .orderBy(F.desc("revenue"), "payment_method", "country")
        .limit(top)
    )


def monthly_revenue(view: DataFrame) -> DataFrame:
    return view.groupBy(_month()).agg(money.total(F.col(_VALUE)).alias("revenue")).orderBy("month")


def device_share(view: DataFrame) -> DataFrame:
    per_device = view.groupBy("device_type").agg(F.count("*").alias("orders"))
    everything = F.sum("orders").over(Window.partitionBy())
    return per_device.select(
        "device_type",
        "orders",
        everything.alias("all_orders"),
        money.percent(F.col("orders"), everything).alias("percent_orders"),
    )


def growth_first_last(view: DataFrame) -> DataFrame:
    """Growth per country from its first month to its last.

    The month totals are read once: the earliest and latest are picked while
    aggregating, so no table is joined to itself.
    """
    monthly = view.groupBy("country", _month()).agg(money.total(F.col(_VALUE)).alias("revenue"))
    first, last = F.col("first_month_revenue"), F.col("last_month_revenue")
    return (
        monthly.groupBy("country")
        .agg(
            F.min_by("revenue", "month").alias("first_month_revenue"),
            F.max_by("revenue", "month").alias("last_month_revenue"),
        )
        .withColumn("growth_percent", money.percent(last - first, first))
    )


def growth_first_last_joined(view: DataFrame) -> DataFrame:
    """The same by joining the month totals with the bounds of each country; kept to compare plans."""
    monthly = view.groupBy("country", _month()).agg(money.total(F.col(_VALUE)).alias("revenue"))
    bounds = monthly.groupBy("country").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    first = monthly.select("country", F.col("month").alias("first_month"), F.col("revenue").alias("first_month_revenue"))
    last = monthly.select("country", F.col("month").alias("last_month"), F.col("revenue").alias("last_month_revenue"))
    return (
        bounds.join(first, ["country", "first_month"])
        .join(last, ["country", "last_month"])
        .select(
            "country",
            "first_month_revenue",
            "last_month_revenue",
            money.percent(
                F.col("last_month_revenue") - F.col("first_month_revenue"), F.col("first_month_revenue")
            ).alias("growth_percent"),
        )
    )


def cities_above_average_blind(view: DataFrame) -> DataFrame:
    """The same with cities and countries compared without case and accents; each city has its least spelling."""
    cities = collated(view, "country", "city").groupBy("country", "city").agg(
        money.total(F.col(_VALUE)).alias("city_revenue"), spelling("country").alias("_country"), spelling("city").alias("_city")
    )
    return _above_average(cities).select(
        F.col("_country").alias("country"), F.col("_city").alias("city"), "city_revenue", "country_average"
    )


def cities_above_average(view: DataFrame) -> DataFrame:
    """Cities whose revenue exceeds the mean city revenue of their country.

    The country means are an aggregate of the city totals and are joined back;
    a window over the country would put all cities of a country in one task.
    """
    cities = view.groupBy("country", "city").agg(money.total(F.col(_VALUE)).alias("city_revenue"))
    return _above_average(cities).select("country", "city", "city_revenue", "country_average").orderBy("country", "city")


def _above_average(cities: DataFrame) -> DataFrame:
    countries = cities.groupBy("country").agg(
        F.sum("city_revenue").alias("_sum"), F.count("city_revenue").alias("_cities")
    )
    return (
        cities.join(countries, "country")
        # compared as city * n > sum, which needs no rounding
        .where(F.col("city_revenue") * F.col("_cities") > F.col("_sum"))
        .withColumn("country_average", F.round(F.col("_sum") / F.col("_cities"), 6))
    )
