"""Questions to ``view_demographic_analysis``.

Windows here run over aggregates with one row per country, gender or category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anonkit.functions import money


def _revenue_by(view: DataFrame, *keys: str) -> DataFrame:
    return view.groupBy(*keys).agg(money.total(F.col("total_revenue")).alias("revenue"))


def _first_per_country(view: DataFrame, attribute: str) -> DataFrame:
    """The attribute value with most revenue in each country."""
    best = Window.partitionBy("country").orderBy(F.desc("revenue"), attribute)
    return (
        _revenue_by(view, "country", attribute)
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") == 1)
        .drop("place")
        .orderBy(F.desc("revenue"), "country")
    )


def rows_per_country(view: DataFrame) -> DataFrame:
    return view.groupBy("country").agg(F.count("*").alias("view_rows")).orderBy(F.desc("view_rows"), "country")


def categories(view: DataFrame) -> DataFrame:
    return view.groupBy("product_category").agg(F.count("*").alias("view_rows"))


def revenue_per_country(view: DataFrame) -> DataFrame:
    return _revenue_by(view, "country").orderBy(F.desc("revenue"), "country")


def revenue_per_gender(view: DataFrame) -> DataFrame:
    return _revenue_by(view, "gender").orderBy(F.desc("revenue"), "gender")


def orders_in_country(view: DataFrame, country: str = "Spain") -> DataFrame:
    """The filter stands before the GROUP BY and reaches the scan."""
    return view.where(F.col("country") == country).groupBy("country").agg(F.sum("n_orders").alias("orders"))


def top_category_per_country(view: DataFrame) -> DataFrame:
    return _first_per_country(view, "product_category")


def category_share(view: DataFrame) -> DataFrame:
    everything = F.sum("revenue").over(Window.partitionBy())
    return _revenue_by(view, "product_category").select(
        "product_category", money.percent(F.col("revenue"), everything).alias("percent_revenue")
    )


def top_age_range(view: DataFrame) -> DataFrame:
    return (
        view.groupBy("age_range")
        .agg(F.sum("n_orders").alias("orders"))
        .orderBy(F.desc("orders"), F.asc_nulls_last("age_range"))
        .limit(1)
    )


def top_gender_per_country(view: DataFrame) -> DataFrame:
    return _first_per_country(view, "gender")


def country_ranking(view: DataFrame) -> DataFrame:
    """Countries from least to most revenue, with the one before and the difference to it."""
    ascending = Window.orderBy("revenue")
    ranked = _revenue_by(view, "country").select(
        F.rank().over(ascending).alias("ranking"),
        "country",
        "revenue",
        F.lag("revenue").over(Window.orderBy("revenue", "country")).alias("previous_revenue"),
    )
    return ranked.withColumn("difference", F.col("revenue") - F.col("previous_revenue"))
