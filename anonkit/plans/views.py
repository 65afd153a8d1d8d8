"""Purpose-limited views over the anonymized order table.

Each shows only the columns its purpose needs. They are plans, not tables:
Spark reads the few columns a question uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anonkit.functions import money
from anonkit.operators import kanon
from anonkit.operators.anonymize import anonymize_orders
from anonkit.schema import Policy

_VALUE = "order_value_random"


def view_geo_analysis(anonymized: DataFrame) -> DataFrame:
    """Market analysis by place and time, one row per order."""
    return anonymized.select(
        "country",
        "city",
        F.col("postal_code_general").alias("region"),
        "product_category",
        F.col(_VALUE).alias("order_value"),
        "order_date",
        "device_type",
        "payment_method",
    )


def view_customer_behavior(anonymized: DataFrame) -> DataFrame:
    """Purchase frequency and lifetime value per hashed customer and segment."""
    value = F.col(_VALUE)
    first, last = F.min("order_date"), F.max("order_date")
    return anonymized.groupBy(F.col("customer_id_hashed").alias("customer_hash"), "customer_segment").agg(
        F.count("*").alias("total_orders"),
        money.mean(value).alias("avg_order_value"),
        money.total(value).alias("total_spent"),
        first.alias("first_order"),
        last.alias("last_order"),
        F.datediff(last, first).alias("customer_lifespan_days"),
    )


def view_demographic_analysis(anonymized: DataFrame) -> DataFrame:
    """Audience profile per gender, country, age range and category."""
    value = F.col(_VALUE)
    return anonymized.groupBy("gender", "country", "age_range", "product_category").agg(
        F.count("*").alias("n_orders"),
        money.mean(value).alias("avg_order_value"),
        money.total(value).alias("total_revenue"),
    )


def view_product_performance(anonymized: DataFrame) -> DataFrame:
    """Categories, devices and payment methods; nothing about people."""
    value = F.col(_VALUE)
    return anonymized.groupBy("product_category", "device_type", "payment_method").agg(
        F.count("*").alias("n_orders"),
        money.mean(value).alias("avg_order_value"),
        F.min(value).alias("min_order_value"),
        F.max(value).alias("max_order_value"),
        money.total(value).alias("total_revenue"),
    )


ALL_VIEWS = {
    "view_geo_analysis": view_geo_analysis,
    "view_customer_behavior": view_customer_behavior,
    "view_demographic_analysis": view_demographic_analysis,
    "view_product_performance": view_product_performance,
}

# Attributes of each view that could single a person out.
VIEW_QUASI_IDENTIFIERS = {
    "view_geo_analysis": ["country", "region"],
    "view_geo_analysis with city": ["country", "city", "region"],
    "view_demographic_analysis": ["gender", "country", "age_range"],
    "view_product_performance": ["product_category", "device_type", "payment_method"],
}
# Of the view that shows single orders, and of the one that shows single people.
ORDER_QUASI_IDENTIFIERS = {"view_geo_analysis by order": ["country", "city", "region", "order_date", "order_value"]}
PERSON_QUASI_IDENTIFIERS = {"view_customer_behavior": ["customer_segment", "total_orders"]}


def k_summary_of_views(orders: DataFrame, policy: Policy) -> DataFrame:
    """Groups of fewer than k people that the columns of each view form.

    Three scans: the coarse sets share one; what a single order shows stays apart, so that the copies of the coarse
    sets are of distinct people; and orders per person are counted before people are grouped.
    """
    rows = kanon.with_quasi_identifiers(orders, policy, "product_category", "device_type", "payment_method")
    single = anonymize_orders(orders, policy).select(
        "customer_id_hashed",
        "country",
        "city",
        F.col("postal_code_general").alias("region"),
        "order_date",
        F.col(_VALUE).alias("order_value"),
    )
    people = orders.groupBy("customer_id", "customer_segment").agg(F.count("*").alias("total_orders"))
    return (
        kanon.k_summary(rows, VIEW_QUASI_IDENTIFIERS)
        .unionByName(kanon.k_summary(single, ORDER_QUASI_IDENTIFIERS, "customer_id_hashed"))
        .unionByName(kanon.k_summary(people, PERSON_QUASI_IDENTIFIERS))
    )
