"""Profiles and previews of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anonkit.functions.keyed import digest


def profile_dataset(orders: DataFrame, top: int = 5) -> DataFrame:
    """Shape, customers, the customers with most orders, and orders per country, as (metric, item, value).

    All figures come from one table of orders per customer and country, which
    Spark shuffles once and reuses.
    """
    base = orders.groupBy("customer_id", "country").agg(F.count("*").alias("n"))
    per_customer = base.groupBy("customer_id").agg(F.sum("n").alias("n"))
    totals = per_customer.agg(F.sum("n").alias("n_rows"), F.count("customer_id").alias("customers")).selectExpr(
        "stack(3, 'rows', n_rows, 'columns', "
        f"cast({len(orders.columns)} as bigint), 'customers', customers) as (metric, value)"
    )
    # NULL is no customer. It is dropped behind the limit: a filter in front would be pushed
    # into the scan, and the table of this branch could not be shared with the others.
    best = (
        per_customer.orderBy(F.col("customer_id").isNull(), F.desc("n"), "customer_id")
        .limit(top)
        .where(F.col("customer_id").isNotNull())
    )
    countries = base.groupBy("country").agg(F.sum("n").alias("n"))
    return (
        totals.select("metric", F.lit("").alias("item"), F.coalesce("value", F.lit(0)).alias("value"))
        .unionByName(best.select(F.lit("top customer").alias("metric"), F.col("customer_id").alias("item"), F.col("n").alias("value")))
        .unionByName(countries.select(F.lit("country").alias("metric"), F.col("country").alias("item"), F.col("n").alias("value")))
    )


def profile_notes_fill(orders: DataFrame, note: str = "customer_notes") -> DataFrame:
    return orders.agg(F.count_if(F.col(note) != "").alias("notes_filled"), F.count("*").alias("total_rows"))


def preview_sample(df: DataFrame, n: int, key: str, seed: str | None = None) -> DataFrame:
    """The first ``n`` rows by key, or with a seed ``n`` rows picked at random but the same ones each time.

    Every task keeps its best ``n`` rows only.
    """
    order = [F.col(key)] if seed is None else [digest(F.col(key).cast("string"), seed), F.col(key)]
    return df.orderBy(*order).limit(n)


def describe(df: DataFrame) -> DataFrame:
    """Name, type and presence of NULL for each column, from one pass over the data."""
    fields = df.schema.fields
    nulls = [F.count_if(F.col(f.name).isNull()).alias(f"c{i}") for i, f in enumerate(fields)]
    stacked = ", ".join(
        f"cast({i} as bigint), '{f.name}', '{f.dataType.simpleString()}', if(c{i} > 0, 'YES', 'NO')"
        for i, f in enumerate(fields)
    )
    return df.agg(*nulls).selectExpr(f"stack({len(fields)}, {stacked}) as (position, col_name, data_type, has_nulls)")
