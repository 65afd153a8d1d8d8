"""Questions to ``view_product_performance`` (one row per category, device and payment method)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anonkit.functions import money

# Fixed value: the name of all other payment methods.
_REST = "Resto"


def _revenue_by(view: DataFrame, *keys) -> DataFrame:
    return view.groupBy(*keys).agg(money.total(F.col("total_revenue")).alias("revenue"))


def revenue_per_category(view: DataFrame) -> DataFrame:
    return _revenue_by(view, "product_category").orderBy(F.desc("revenue"), "product_category")


def orders_per_device(view: DataFrame) -> DataFrame:
    return (
        view.groupBy("device_type").agg(F.sum("n_orders").alias("orders")).orderBy(F.desc("orders"), "device_type")
    )


def extreme_averages(view: DataFrame) -> DataFrame:
    return view.agg(F.max("avg_order_value").alias("highest_avg"), F.min("avg_order_value").alias("lowest_avg"))


def combinations_above(view: DataFrame, min_value: int = 30) -> DataFrame:
    return view.where(F.col("min_order_value") > min_value).orderBy(
        F.desc("min_order_value"), "product_category", "device_type", "payment_method"
    )


def top_payment_method(view: DataFrame) -> DataFrame:
    """Ordered by the unrounded mean; the rounded one is shown."""
    average = F.sum("avg_order_value") / F.count("avg_order_value")
    return (
        view.groupBy("payment_method")
        .agg(average.alias("_exact"), money.mean(F.col("avg_order_value")).alias("mean_avg_order_value"))
        .orderBy(F.desc("_exact"), "payment_method")
        .limit(1)
        .drop("_exact")
    )


def combination_share(view: DataFrame) -> DataFrame:
    everything = F.sum("revenue").over(Window.partitionBy())
    return (
        _revenue_by(view, "product_category", "device_type")
        .withColumn("percent_revenue", money.percent(F.col("revenue"), everything))
        .orderBy(F.desc("revenue"), "product_category", "device_type")
    )


def value_range(view: DataFrame) -> DataFrame:
    highest, lowest = F.max("max_order_value"), F.min("min_order_value")
    return (
        view.groupBy("product_category")
        .agg(highest.alias("highest"), lowest.alias("lowest"), (highest - lowest).alias("value_range"))
        .orderBy(F.desc("value_range"), "product_category")
    )


def method_against_rest(view: DataFrame, method: str = "Klarna", rest: str = _REST) -> DataFrame:
    group = F.when(F.col("payment_method") == method, method).otherwise(rest).alias("payment_group")
    everything = F.sum("revenue").over(Window.partitionBy())
    return _revenue_by(view, group).select(
        "payment_group",
        "revenue",
        everything.alias("all_revenue"),
        money.percent(F.col("revenue"), everything).alias("percent_revenue"),
    )


def category_rank_in_device(view: DataFrame) -> DataFrame:
    by_revenue = Window.partitionBy("device_type").orderBy(F.desc("revenue"))
    return _revenue_by(view, "device_type", "product_category").withColumn("ranking", F.dense_rank().over(by_revenue))


def running_total(view: DataFrame) -> DataFrame:
    """Running revenue in each category, largest combinations first.

    A category has as many rows as there are devices times payment methods.
    """
    so_far = (
        Window.partitionBy("product_category")
        .orderBy(F.desc("n_orders"), "device_type", "payment_method")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return view.select(
        "product_category",
        "device_type",
        "payment_method",
        "n_orders",
        "total_revenue",
        F.sum("total_revenue").over(so_far).alias("running_total"),
    ).orderBy("product_category", F.desc("n_orders"), "device_type", "payment_method")
