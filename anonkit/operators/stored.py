"""Updates of stored tables that write only what changes, in batch and from a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anonkit.operators.incremental import update_by_key
from anonkit.sources.scratch import as_table


def update_stored(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str,
    columns: list[str],
    partitions: list[str],
    latest_by: str | None = None,
) -> DataFrame:
    """Set ``columns`` of the rows of a partitioned Parquet table whose ``key`` occurs in ``updates``.

    ``updates`` may carry the ``partitions`` columns of their rows; then only these partitions are read. Otherwise the
    key column alone is scanned to find them. Partitions without such a row are neither read in full nor written: the touched
    ones are joined, and replaced by dynamic partition overwrite once all new files are there. Running it again with the
    same updates gives the same table, so a run that died is repeated. Returns the touched partitions.
    """
    table = spark.read.parquet(path)
    order = [latest_by] if latest_by else []
    given = [p for p in partitions if p in updates.columns]
    news = as_table(updates.select(key, *columns, *order, *given).where(F.col(key).isNotNull()), "updates")
    if given == partitions:
        touched = news.select(*partitions).distinct()
    else:
        touched = table.join(news.select(key).distinct(), key, "left_semi").select(*partitions).distinct()
    touched = as_table(touched, "touched")
    if touched.isEmpty():
        return touched
    # a semi-join on the partition columns: Spark prunes the scan to the partitions of the small side
    names = {p: f"_touched_{p}" for p in partitions}
    same = [F.col(p).eqNullSafe(F.col(n)) for p, n in names.items()]
    rows = table.join(touched.withColumnsRenamed(names), same, "left_semi")
    changed = update_by_key(rows, news, key, columns, latest_by)
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    return touched


def _done_batches(spark: SparkSession, ledger: str) -> set[int]:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location):
        return set()
    last = spark.read.schema("batch_id bigint").parquet(ledger).agg(F.max("batch_id")).first()[0]
    return set() if last is None else {last}


def update_from_stream(
    stream: DataFrame,
    path: str,
    ledger: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    key: str,
    columns: list[str],
    partitions: list[str],
    latest_by: str | None = None,
) -> None:
    """Put what ``transform`` makes of each batch of ``stream`` into the stored table, by key, then stop.

    A batch is written to the table first and to the ``ledger`` after. A batch that the ledger knows is passed over; one that
    died between the two is applied again, which changes nothing, as an update sets values by key. So the table is the
    same whether or not batches were replayed.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if any(batch_id <= done for done in _done_batches(spark, ledger)):
            return
        update_stored(spark, path, transform(batch), key, columns, partitions, latest_by)
        spark.range(batch_id, batch_id + 1, 1, 1).select(F.col("id").alias("batch_id")).write.mode("append").parquet(ledger)

    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
