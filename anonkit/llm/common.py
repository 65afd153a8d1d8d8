"""Helpers that several operators share."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from anonkit.sources.scratch import fresh_dir
from anonkit.sources.tables import read_test_table

SALTS = 16
BATCH_BYTES = 1 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application.

    The archive goes to the shared folder, and Spark hands it to the workers. A cluster that has
    the package installed is not harmed: the code is the same.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
        for path in sorted(root.rglob("*.py")):
            target.write(path, f"{root.name}/{path.relative_to(root)}")
    path = f"{fresh_dir(spark, 'package')}/{root.name}.zip"
    stream = context._jvm.org.apache.hadoop.fs.Path(path)
    output = stream.getFileSystem(context._jsc.hadoopConfiguration()).create(stream)
    try:
        output.write(bytearray(archive.getvalue()))
    finally:
        output.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at ``BATCH_BYTES``, unless the session has a limit of its own.

    Spark's other limit counts rows (10,000): with whole texts a batch grows with their length, in the worker, in the
    JVM's buffers, and in the rows that wait there for the worker's answer. No result depends on where batches end.
    """
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return read_test_table(spark, sf_dir, name)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there, and a lost executor takes nothing with it."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, columns: list[str], work: Callable[..., dict[str, object]], schema: str) -> DataFrame:
    """Run ``work`` on the Arrow batches of ``columns``; nothing else is sent to Python.

    ``work`` gets the batch's columns and returns a dict of new columns, each as long as the batch
    or, if ``work`` makes rows, all of one length.
    """
    target = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(*[batch.column(name) for name in columns])
            yield pa.RecordBatch.from_arrays([as_array(made[f.name], f.type) for f in target], schema=target)

    return df.select(*columns).mapInArrow(run, schema)


def as_array(values: object, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, kind)


_ARROW = {
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
    T.StringType(): pa.string(),
    T.BinaryType(): pa.binary(),
}


def pa_type(kind: T.DataType) -> pa.DataType:
    return pa.list_(pa_type(kind.elementType)) if isinstance(kind, T.ArrayType) else _ARROW.get(kind) or to_arrow_type(kind)


def pa_schema(ddl: str) -> pa.Schema:
    return pa.schema([(f.name, pa_type(f.dataType)) for f in T.StructType.fromDDL(ddl).fields])


def own_columns(df: DataFrame, prefix: str = "_w") -> Callable[[str], str]:
    """Names for helper columns that ``df`` does not have yet."""
    taken = {name.lower() for name in df.columns}

    def name(label: str) -> str:
        candidate = f"{prefix}_{label}"
        while candidate.lower() in taken:
            candidate = f"_{candidate}"
        return candidate

    return name


def salted_join(many: DataFrame, few: DataFrame, on: list[str], how: str, by: list[str | Column]) -> DataFrame:
    """A join in which each row of ``few`` stands in ``SALTS`` places, and rows of ``many`` go to one of them by the columns ``by``."""
    salt = own_columns(many)("salt")
    left = many.withColumn(salt, F.pmod(F.xxhash64(*by), F.lit(SALTS)))
    right = few.withColumn(salt, F.explode(F.lit(list(range(SALTS))).cast("array<bigint>")))
    return left.join(right, [*on, salt], how).drop(salt)


def tokenizer_path(name: str) -> str:
    """File of a public tokenizer; looked up where it is used, as executors have their own copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


def quiet_tokenizers() -> None:
    """A task has one core; the tokenizer library must not start a thread for each core of the machine."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


__all__ = ["F", "bound_batches", "map_rows", "own_columns", "pa_schema", "quiet_tokenizers", "salted_join", "table", "tokenizer_path", "written"]


# Byte to byte: A-Z become a-z; a-z, digits and all bytes of non-ASCII characters stay; the rest parts words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def spaced_bytes(text: str | None) -> bytes:
    """A text with A-Z in lower case, in UTF-8, with spaces for what parts words."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)


def word_bytes(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z in lower case, in UTF-8."""
    return spaced_bytes(text).split()
