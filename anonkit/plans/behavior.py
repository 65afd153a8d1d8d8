"""Questions to ``view_customer_behavior`` (one row per hashed customer and segment)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anonkit.functions import masks, money


def customers(view: DataFrame) -> DataFrame:
    return view.agg(F.countDistinct("customer_hash").alias("customers"))


def customers_per_segment(view: DataFrame, segments: tuple[str, ...] = ("New", "Regular")) -> DataFrame:
    return (
        view.where(F.col("customer_segment").isin(*segments))
        .groupBy("customer_segment")
        .agg(F.count("customer_segment").alias("customers"))
    )


def average_spend(view: DataFrame) -> DataFrame:
    return view.agg(money.mean(F.col("total_spent"), 3).alias("avg_total_spent"))


def top_spenders(view: DataFrame, top: int = 5) -> DataFrame:
    """A customer may appear in several segments, so spend is summed per customer first."""
    return (
        view.groupBy("customer_hash")
        .agg(F.sum("total_spent").alias("total_spent"))
        .orderBy(F.desc("total_spent"), "customer_hash")
        .limit(top)
    )


def frequent_customers(view: DataFrame, more_than: int = 10) -> DataFrame:
    return view.where(F.col("total_orders") > more_than).agg(F.count("customer_hash").alias("customers"))


def order_histogram(view: DataFrame, more_than: int = 10) -> DataFrame:
    return (
        view.where(F.col("total_orders") > more_than)
        .groupBy("total_orders")
        .agg(F.count("customer_hash").alias("customers"))
        .orderBy(F.desc("total_orders"))
    )


def average_order_by_segment(view: DataFrame) -> DataFrame:
    return (
        view.groupBy("customer_segment")
        .agg(money.mean(F.col("avg_order_value")).alias("avg_order_value"))
        .orderBy(F.desc("avg_order_value"), "customer_segment")
    )


def segment_share(view: DataFrame) -> DataFrame:
    """The window runs over one row per segment, not over customers."""
    per_segment = view.groupBy("customer_segment").agg(F.count("*").alias("n"))
    everyone = F.sum("n").over(Window.partitionBy())
    return per_segment.select("customer_segment", money.percent_raw(F.col("n"), everyone).alias("percent_customers"))


def regular_share(view: DataFrame, segment: str = "Regular") -> DataFrame:
    members = F.count_if(F.col("customer_segment") == segment)
    return view.agg(money.percent_raw(members, F.count("*")).alias("percent_regular"))


def active_longer_than(view: DataFrame, days: int = 365) -> DataFrame:
    active = F.count_if(F.col("customer_lifespan_days") > days)
    return view.agg(
        active.alias("active_customers"), money.percent_raw(active, F.count("*")).alias("percent_active")
    )


def best_per_segment(view: DataFrame) -> DataFrame:
    """Best customer of each segment.

    Spark turns the filter on the row number into a limit per task before the
    shuffle, so a segment's task receives one row from each other task.
    """
    by_spend = Window.partitionBy("customer_segment").orderBy(F.desc("total_spent"), "customer_hash")
    return (
        view.select("customer_segment", "customer_hash", "total_spent")
        .withColumn("place", F.row_number().over(by_spend))
        .where(F.col("place") == 1)
        .drop("place")
        .orderBy(F.desc("total_spent"), "customer_segment")
    )


def most_inactive(view: DataFrame, as_of: dt.date | None = None, top: int = 10) -> DataFrame:
    """Days since the last order, longest first."""
    days = F.datediff(masks.as_of_date(as_of), F.col("last_order"))
    return (
        view.select("customer_hash", days.alias("days_inactive"))
        .orderBy(F.desc("days_inactive"), "customer_hash")
        .limit(top)
    )
