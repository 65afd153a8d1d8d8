"""Stored tables: updates of touched partitions only, keyed updates from streams, safe refresh, added columns, collation."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from anonkit.operators import collation, stored
from anonkit.sources import tables
from anonkit.streaming import jobs


def files(path):
    return {p.relative_to(path) for p in Path(path).rglob("*.parquet")}


def month_table(spark, path, n=60):
    spark.range(n).select("id", F.concat(F.lit("m"), F.col("id") % 6).alias("month"), F.lit("old").alias("note")).write.partitionBy("month").parquet(path)


def notes(spark, path):
    return {r.id: r.note for r in spark.read.parquet(path).collect()}


@pytest.mark.parametrize("with_partition", [False, True])
def test_only_touched_partitions_are_written(spark, tmp_path, with_partition):
    path = str(tmp_path / "t")
    month_table(spark, path)
    before = files(path)
    news = spark.createDataFrame([(3, "m3", "new"), (9, "m3", None), (4, "m4", "new"), (4, "m4", "newer"), (None, "m5", "x"), (999, "m0", "x")], "id long, month string, note string")
    if not with_partition:
        news = news.drop("month")
    expected = {i: "old" for i in range(60)} | {3: "new", 9: None, 4: "newer"}
    for _ in range(2):  # again, with the same result
        touched = stored.update_stored(spark, path, news, "id", ["note"], ["month"])
        assert notes(spark, path) == expected
    after = files(path)
    written = {f.parts[0] for f in after - before}
    assert written == ({"month=m0", "month=m3", "month=m4"} if with_partition else {"month=m3", "month=m4"})
    assert {f"month={r.month}" for r in touched.collect()} >= written
    assert {f for f in before if f.parts[0] in ("month=m1", "month=m2", "month=m5")} <= after


def test_no_updates_write_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    month_table(spark, path)
    before = files(path)
    stored.update_stored(spark, path, spark.createDataFrame([], "id long, note string"), "id", ["note"], ["month"])
    assert files(path) == before


def test_stream_that_dies_before_its_ledger(spark, tmp_path, monkeypatch):
    source, path, ledger, checkpoint = (str(tmp_path / p) for p in ("source", "t", "ledger", "checkpoint"))
    month_table(spark, path)
    arrive = lambda low, high, text: (
        spark.range(low, high, 1, 1).select("id", F.lit(text).alias("note")).write.mode("append").parquet(source)
    )
    arrive(0, 10, "a")

    def run():
        stream = spark.readStream.schema("id long, note string").option("maxFilesPerTrigger", 1).parquet(source)
        stored.update_from_stream(stream, path, ledger, checkpoint, lambda b: b, "id", ["note"], ["month"])

    real, calls = stored.update_stored, []

    def dies_after_writing(*args, **kwargs):
        real(*args, **kwargs)
        calls.append(1)
        raise RuntimeError("lost")

    monkeypatch.setattr(stored, "update_stored", dies_after_writing)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(stored, "update_stored", real)
    run()  # the batch is replayed
    arrive(5, 15, "b")
    run()
    run()
    assert calls == [1]
    assert notes(spark, path) == {i: "a" if i < 5 else "b" if i < 15 else "old" for i in range(60)}
    assert sorted(r.batch_id for r in spark.read.parquet(ledger).collect()) == [0, 1]


def test_batch_that_the_ledger_knows_is_passed_over(spark, tmp_path):
    source, path, ledger = (str(tmp_path / p) for p in ("source", "t", "ledger"))
    month_table(spark, path)
    spark.range(0, 10, 1, 1).select("id", F.lit("a").alias("note")).write.parquet(source)
    spark.range(1).select(F.col("id").alias("batch_id")).write.parquet(ledger)
    stream = spark.readStream.schema("id long, note string").parquet(source)
    stored.update_from_stream(stream, path, ledger, str(tmp_path / "c"), lambda b: b, "id", ["note"], ["month"])
    assert set(notes(spark, path).values()) == {"old"}


def test_notes_stream_with_a_byte_limit(spark, orders, tmp_path):
    source, path, ledger, checkpoint = (str(tmp_path / p) for p in ("source", "t", "ledger", "checkpoint"))
    month = F.date_format("order_date", "yyyy-MM").alias("order_month")
    orders.select("order_id", F.lit(None).cast("string").alias("customer_notes_anonymized"), month).write.partitionBy("order_month").parquet(path)
    orders.repartition(4).write.parquet(source)
    jobs.update_notes_stream(spark, source, path, ledger, checkpoint, max_bytes_per_trigger="1")
    assert spark.read.parquet(ledger).count() == 4
    from anonkit.operators.redact import redact_notes

    same = spark.read.parquet(path).select("order_id", "customer_notes_anonymized")
    batch = redact_notes(orders).select("order_id", "customer_notes_anonymized")
    assert same.exceptAll(batch).isEmpty() and batch.exceptAll(same).isEmpty()


@pytest.fixture
def database(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    tables.use_database(spark, f"db_{tmp_path.name.replace('-', '_')}", str(tmp_path / "db"))
    yield
    spark.catalog.setCurrentDatabase(before)


def test_readers_see_old_or_new_rows(spark, database):
    assert tables.refresh_table(spark.range(5).toDF("x"), "t") is None
    reader = spark.table("t")
    assert reader.count() == 5
    during = []

    def look(x):
        return x

    rows = spark.range(7).toDF("x")
    old = tables.refresh_table(rows, "t")
    during.append(reader.count())  # a plan made before still finds its files
    assert during == [5] and old and spark.table("t").count() == 7
    tables.refresh_table(spark.table("t").where("x < 3"), "t")  # it may read itself
    assert spark.table("t").count() == 3


def test_failed_load_changes_nothing(spark, database):
    tables.refresh_table(spark.range(5).toDF("x"), "t")
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        tables.refresh_table(bad, "t")
    with pytest.raises(ValueError, match="as it was"):
        tables.refresh_table(spark.range(2).toDF("y"), "t")
    assert spark.table("t").count() == 5


def test_added_column_leaves_the_files(spark, database, tmp_path):
    tables.create_table_as(spark.range(4).toDF("x"), "t")
    before = files(tmp_path)
    assert before
    assert tables.add_stored_column(spark, "t", "note")
    assert not tables.add_stored_column(spark, "t", "NOTE")
    assert files(tmp_path) == before
    assert [tuple(r) for r in spark.table("t").orderBy("x").collect()] == [(i, None) for i in range(4)]
    spark.sql("INSERT INTO t VALUES (9, 'new')")
    assert spark.table("t").where("note = 'new'").count() == 1


def test_blind_groups(spark):
    names = ["Málaga", "malaga", "MALAGA", "Malága", "Madrid", None, "madrid"] + ["málaga"] * 50
    df = spark.createDataFrame([(n,) for n in names], "city string")
    got = {(r.spelling, r.spellings, r.rows) for r in collation.group_spellings(df, "city").collect()}
    assert got == {("MALAGA", 5, 54), ("Madrid", 2, 2), (None, 0, 1)}
    assert collation.collated(df, "city").where("city = 'MÁLAGA'").count() == 54
    assert collation.collated(df, "city").distinct().count() == 3
