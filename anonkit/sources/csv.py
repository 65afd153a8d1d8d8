"""CSV with newlines and quotes inside quoted fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anonkit.schema import ORDERS_SCHEMA

# Quotes are doubled inside quoted fields, and blanks belong to the value.
_FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# The reader puts this in bare empty fields and then reads it as NULL. With the
# default, an empty string, it would take quoted empty fields for NULL too.
_NULL_MARK = "\x01"


def read_csv(spark: SparkSession, path: str, schema: T.StructType = ORDERS_SCHEMA) -> DataFrame:
    """Read one file or a folder of files.

    A field may hold newlines, so a file cannot be split: it is one task. Large
    data should come as many files, or be converted to parquet once. A bare
    empty field is NULL, a quoted one an empty string; see :func:`null_if_blank`.
    A field that is exactly the control character 1 is read as NULL, too.
    """
    options = {**_FORMAT, "multiLine": "true", "mode": "FAILFAST", "nullValue": _NULL_MARK, "emptyValue": ""}
    return spark.read.schema(schema).options(**options).csv(path)


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType = ORDERS_SCHEMA) -> DataFrame:
    """Read the same files as :func:`read_csv` with many tasks per file, although fields hold newlines.

    A line ends a record if an even number of quotes stands before its end, counted from the start of the file. Lines are
    read in splits; each split's quotes are summed, running sums over the splits of a file say whether a split
    begins inside a field, and a running sum in the split says it of each line. A line that begins and ends outside fields is a
    record; only the lines of longer records are put together again. Spark parses the records. The first record of each file
    is its header. A file with an odd number of quotes is an error.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    # in a split, row numbers rise in the order of its lines
    lines = lines.select("value", place.alias("split"), F.monotonically_increasing_id().alias("n"))
    lines = lines.withColumn("quotes", F.regexp_count("value", F.lit('"')).cast("bigint"))
    # per line: quotes before it in its split; a split is some 128 MB, whatever the size of the file
    own = Window.partitionBy("split").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = lines.withColumn("upto", F.sum("quotes").over(own))
    splits = lines.groupBy("split").agg(F.sum("quotes").alias("quotes"))
    earlier = Window.partitionBy("split.file").orderBy("split.start").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    offsets = splits.select("split", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("offset"))
    at = scanned.join(offsets, "split").select(
        "split", "n", "value", ((F.col("offset") + F.col("upto") - F.col("quotes")) % 2 == 0).alias("begins"),
        ((F.col("offset") + F.col("upto")) % 2).alias("open"),
    )
    # number records within a split; lines before the first border belong to the last record of an earlier split
    at = at.withColumn("record", F.sum(F.col("begins").cast("bigint")).over(own))
    whole = F.col("begins") & (F.col("open") == 0)
    header = (F.col("split.start") == 0) & (F.col("record") == 1)
    alone = at.where(whole & ~header).select(F.col("value").alias("text"))
    # what is open at the end of a split is its last record of several lines
    parts = at.where(~whole)
    last = parts.groupBy("split").agg(F.max("record").alias("record")).withColumn(
        "before", F.last(F.when(F.col("record") > 0, F.struct(F.col("split.start"), "record")), ignorenulls=True).over(earlier)
    )
    own_record = F.struct(F.col("split.start"), "record")
    records = (
        parts.join(last.select("split", "before"), "split")
        .groupBy(F.col("split.file").alias("file"), F.when(F.col("record") > 0, own_record).otherwise(F.col("before")).alias("record"))
        .agg(F.sort_array(F.collect_list(F.struct("split.start", "n", "value", "open"))).alias("lines"))
    )
    text = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    closed = F.when(F.element_at("lines", -1)["open"] == 0, text).otherwise(F.raise_error(F.lit("a quote is never closed")).cast("string"))
    is_header = (F.col("record.start") == 0) & (F.col("record.record") == 1)
    joined = records.where(~is_header).select(closed.alias("text"))
    bare = F.regexp_replace("text", "\r$", "")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {**_FORMAT, "mode": "FAILFAST", "nullValue": _NULL_MARK, "emptyValue": "", "multiLine": "true"}
    del options["header"]
    kept = alone.unionByName(joined).where(bare != "").select(F.from_csv(bare, fields, options).alias("row"))
    return kept.select("row.*")


def write_csv(df: DataFrame, path: str, max_records_per_file: int = 500_000) -> None:
    """Write files small enough that reading them back stays parallel. An empty string is kept apart from NULL."""
    (
        df.write.mode("overwrite")
        .options(emptyValue='""', nullValue="", maxRecordsPerFile=str(max_records_per_file), **_FORMAT)
        .csv(path)
    )


def null_if_blank(df: DataFrame) -> DataFrame:
    """Empty strings and NaN to NULL in all columns."""

    def normalized(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.when(column != "", column).alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(column), column).alias(field.name)
        return column

    return df.select(*[normalized(f) for f in df.schema.fields])
