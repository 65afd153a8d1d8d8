"""Where jobs put tables of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else a subfolder of the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/anonkit-scratch"


def fresh_dir(spark: SparkSession, label: str) -> str:
    """Path below the shared folder that nobody used before."""
    return f"{shared_base(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def as_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows does not compute it again."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
