"""Spark session settings the package is written for."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# Settings that decide results (time zone, ANSI) or speed (AQE, size of generated methods: Java
# does not compile a method of more than 8,000 bytes, so beyond that Spark's split code is faster).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_MIB = 1024 * 1024
_MAX_SPLITS = 100_000
_MAX_SHUFFLE_PARTITIONS = 50_000


def scale_conf(input_bytes: int, *, shuffle_share: float = 0.1, least_partitions: int = 8) -> dict[str, str]:
    """Partition settings for an input of ``input_bytes``.

    ``shuffle_share`` is the part of the input that reaches a shuffle after
    column pruning and map-side aggregation. Partitions are about 128 MiB, and
    larger for very large inputs: the driver keeps a status for each pair of
    map task and shuffle partition, so both numbers have a ceiling. AQE merges
    small shuffle partitions, so aiming high costs little.
    """
    split = max(128 * _MIB, math.ceil(input_bytes / _MAX_SPLITS))
    shuffle = math.ceil(input_bytes * shuffle_share / (128 * _MIB))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * _MIB),
        "spark.sql.shuffle.partitions": str(min(max(least_partitions, shuffle), _MAX_SHUFFLE_PARTITIONS)),
    }


def build_session(app_name: str = "anonkit", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with :data:`BASE_CONF`; ``conf`` overrides or adds settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
