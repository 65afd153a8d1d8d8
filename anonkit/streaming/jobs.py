"""Stateless file-to-file streams.

They run the same projections as the batch jobs. Spark's checkpoint says which
files are done and the sink's log which rows count, so a run that dies is
started again and continues without doubling or losing rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from anonkit.operators.anonymize import export_orders
from anonkit.operators.redact import redacted_note
from anonkit.operators.stored import update_from_stream
from anonkit.schema import ORDERS_SCHEMA, Policy


def run_files(
    spark: SparkSession,
    transform: Callable[[DataFrame], DataFrame],
    source: str,
    sink: str,
    checkpoint: str,
    schema: T.StructType = ORDERS_SCHEMA,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> StreamingQuery:
    """Process the parquet files that arrived since the last run, then stop.

    By default one batch takes all files. ``max_bytes_per_trigger`` (a
    whole number of bytes) bounds what is done again after a crash; it should
    be many times what the cluster reads at once. ``transform`` must keep no state.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    query = (
        transform(reader.parquet(source))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def anonymize_stream(
    spark: SparkSession,
    policy: Policy,
    source: str,
    sink: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> StreamingQuery:
    """Anonymize order files with redacted notes; the batch twin is ``export_orders``."""
    return run_files(
        spark,
        lambda orders: export_orders(orders, policy),
        source,
        sink,
        checkpoint,
        max_files_per_trigger=max_files_per_trigger,
        max_bytes_per_trigger=max_bytes_per_trigger,
    )


def redacted_notes_only(orders: DataFrame) -> DataFrame:
    note = F.col("customer_notes")
    birth_date = F.col("birth_date") if "birth_date" in orders.columns else None
    return orders.where(note != "").select("order_id", redacted_note(note, birth_date).alias("customer_notes_anonymized"))


def redact_notes_stream(
    spark: SparkSession, source: str, sink: str, checkpoint: str, max_bytes_per_trigger: str | None = None
) -> StreamingQuery:
    """Redact the notes of order files, committing after every ``max_bytes_per_trigger``."""
    return run_files(
        spark, redacted_notes_only, source, sink, checkpoint, max_bytes_per_trigger=max_bytes_per_trigger
    )


def update_notes_stream(
    spark: SparkSession, source: str, table: str, ledger: str, checkpoint: str, max_bytes_per_trigger: str | None = None
) -> None:
    """Redact the notes of order files and put them into the stored table of orders, partitioned by ``order_month``.

    The table has the columns ``order_id``, ``customer_notes_anonymized`` and ``order_month``, and any others.
    """
    reader = spark.readStream.schema(ORDERS_SCHEMA)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)

    def redacted(orders: DataFrame) -> DataFrame:
        note = redacted_note(F.col("customer_notes"), F.col("birth_date")).alias("customer_notes_anonymized")
        month = F.date_format("order_date", "yyyy-MM").alias("order_month")
        return orders.where(F.col("customer_notes") != "").select("order_id", note, month)

    update_from_stream(
        reader.parquet(source), table, ledger, checkpoint, redacted, "order_id", ["customer_notes_anonymized"], ["order_month"]
    )
