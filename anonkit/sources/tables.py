"""Tables and views: scan, refresh, reconcile, create."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anonkit.sources.scratch import fresh_dir

# The tables of the test data.
TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Full scan of a catalog table, or of a parquet folder if the name holds a slash."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace all rows of the table at ``path``. Running it again gives the same table.

    ``df`` must not read from ``path``.
    """
    df.write.mode("overwrite").parquet(path)


def refresh_table(df: DataFrame, name: str) -> str | None:
    """Replace all rows of the catalog table ``name`` by ``df``, safely for its readers. Returns the old location, if any.

    The rows are loaded into a new folder and counted there; only if all have arrived does one catalog change point the
    table to it. Until then, and after a load that failed, readers get the old rows. The old files stay, so queries that
    have begun end well; the caller removes them when no reader is left. ``df`` may read the table itself.
    """
    spark = df.sparkSession
    location = fresh_dir(spark, f"table-{name.replace('`', '').replace('.', '-')}")
    sent = Observation()
    df.observe(sent, F.count(F.lit(1)).alias("rows")).write.parquet(location)
    loaded = spark.read.schema(df.schema).parquet(location).count()
    if loaded != sent.get["rows"]:
        raise RuntimeError(f"{loaded} of {sent.get['rows']} rows of {name} were loaded; the table is as it was")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{location}'")
        return None
    stored = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
    if stored != [(f.name, f.dataType) for f in df.schema.fields]:
        raise ValueError(f"the columns of {name} are {stored}; the table is as it was")
    old = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return old


def add_stored_column(spark: SparkSession, name: str, column: str, data_type: str | T.DataType = "string") -> bool:
    """Add ``column`` to the catalog table ``name`` unless it is there. No data file is touched; old rows read as NULL."""
    if column.lower() in (c.lower() for c in spark.table(name).columns):
        return False
    kind = data_type if isinstance(data_type, str) else data_type.simpleString()
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{column}` {kind})")
    return True


def reconcile(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """Row counts of a source and of what was loaded from it, in one row."""
    counts = (
        source.select(F.lit("expected").alias("side"))
        .unionByName(loaded.select(F.lit("loaded").alias("side")))
        .groupBy("side")
        .count()
    )
    side = F.col("side")
    return counts.agg(
        F.coalesce(F.sum(F.when(side == "expected", F.col("count"))), F.lit(0)).alias("expected_rows"),
        F.coalesce(F.sum(F.when(side == "loaded", F.col("count"))), F.lit(0)).alias("loaded_rows"),
    ).withColumn("difference", F.col("expected_rows") - F.col("loaded_rows"))


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Make ``name`` the current database, creating it at ``location`` if it does not exist."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    spark.catalog.setCurrentDatabase(name)


def create_table_as(df: DataFrame, name: str) -> None:
    """Drop the table if it exists and create it from ``df``."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def create_views(views: dict[str, DataFrame]) -> None:
    """Register each DataFrame as a session view; nothing is computed."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
