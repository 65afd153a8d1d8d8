"""Work on the rows that still need it, and put results back by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anonkit.functions.keyed import bernoulli
from anonkit.operators.redact import pending


def add_column_if_missing(df: DataFrame, column: str, data_type: str | T.DataType = "string") -> DataFrame:
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast(data_type))


def fill_notes(df: DataFrame, note: str = "customer_notes") -> DataFrame:
    """Make sure there is a text column of notes without NULL."""
    df = add_column_if_missing(df, note)
    return df.withColumn(note, F.coalesce(F.col(note).cast("string"), F.lit("")))


def pending_rows(
    df: DataFrame,
    note: str = "customer_notes",
    done: str = "customer_notes_anonymized",
    finished: DataFrame | None = None,
    key: str = "order_id",
) -> DataFrame:
    """Rows with a note and no result, neither in the ``done`` column nor, by key, in ``finished``.

    ``finished`` is made distinct by the key the join needs anyway, so a key
    that was logged many times is one row when it is shuffled.
    """
    rows = add_column_if_missing(df, done)
    rows = rows.where(pending(F.col(note), F.col(done)))
    return rows if finished is None else rows.join(finished.select(key).distinct(), key, "left_anti")


def pick_rows(df: DataFrame, probability: float, salt: str, key: str = "order_id", among: Column | None = None) -> DataFrame:
    """Bernoulli pick that gives the same rows in every run and for every partitioning."""
    picked = bernoulli(F.col(key), probability, salt)
    return df.where(picked if among is None else among & picked)


def update_by_key(
    base: DataFrame, updates: DataFrame, key: str, columns: list[str], latest_by: str | None = None
) -> DataFrame:
    """``base`` with ``columns`` taken from ``updates`` where the key occurs there, NULL values included.

    Several updates of one key count as one: the one with the highest
    ``latest_by``, among equal ones the greatest values. So no row is ever doubled.
    """
    values = F.struct(*[F.col(c) for c in columns])
    chosen = F.max(values) if latest_by is None else F.max_by(values, F.struct(F.col(latest_by), *columns))
    single = updates.groupBy(F.col(key).alias("_key")).agg(chosen.alias("_new"))
    joined = base.join(single, F.col(key) == F.col("_key"), "left")
    return joined.select(
        *[
            F.when(F.col("_key").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in base.columns
        ]
    )
