"""CSV, refresh, updates, increments, profiles, streams, scratch folders."""

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from anonkit.operators import incremental, profile
from anonkit.operators.anonymize import anonymize_orders, export_orders, suppress_columns
from anonkit.plans import geo, views
from anonkit.schema import COLUMN_TREATMENTS, ORDERS_SCHEMA, Policy
from anonkit.sources import csv, tables
from anonkit.sources.orders import gen_orders
from anonkit.sources.scratch import fresh_dir, shared_base
from anonkit.streaming import jobs

POLICY = Policy(noise_salt="salt", as_of=dt.date(2026, 1, 1))


# ---- CSV --------------------------------------------------------------------


def test_csv_with_newlines_and_quotes(spark, tmp_path):
    (tmp_path / "f.csv").write_text('id,note\n1,"a\nb"\n2,"say ""hi"""\n3,\n')
    rows = csv.read_csv(spark, str(tmp_path), "id int, note string").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "a\nb"), (2, 'say "hi"'), (3, None)]


def test_csv_round_trip_keeps_every_character(spark, tmp_path):
    notes = ["", None, " blanks ", 'q"u"o', "a,b", "a\nb", "a\r\nb", "back\\slash", '"', "\\", "é😀", '","', "\ttab\t", "\n"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(notes)], "i int, note string")
    csv.write_csv(df, str(tmp_path / "out"))
    got = {r.i: r.note for r in csv.read_csv(spark, str(tmp_path / "out"), df.schema).collect()}
    assert got == dict(enumerate(notes))


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path):
    """The rows of the multi-line reader, from splits so small that records cross several of them."""
    notes = ["", None, " blanks ", 'q"u"o', "a,b", "a\nb", "a\r\nb", "back\\slash", '"', "\\", "é😀", '","', "\ttab\t", "\n", "x\n" * 50, '"\n"' * 20]
    rows = [(i, notes[i % len(notes)], "end") for i in range(600)]
    df = spark.createDataFrame(rows, "i int, note string, last string").coalesce(1)
    for name in ("one", "two"):
        csv.write_csv(df, str(tmp_path / "out" / name), max_records_per_file=0)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        reader = csv.read_csv_split(spark, str(tmp_path / "out" / "*"), df.schema)
        assert spark.read.text(str(tmp_path / "out" / "*")).rdd.getNumPartitions() > 40
        got = sorted(map(tuple, reader.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(rows * 2, key=str)


def test_csv_is_written_by_several_tasks(spark, sf_dir, tmp_path):
    """The tasks of the order table write a file each, up to one for each core, and no order is lost."""
    from anonkit.plans.registry import run

    spark.read.parquet(f"{sf_dir}/orders.parquet").repartition(12).write.parquet(str(tmp_path / "orders.parquet"))
    spark.read.parquet(f"{sf_dir}/customer.parquet").write.parquet(str(tmp_path / "customer.parquet"))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task for each file
    try:
        read = run("src_csv_split", spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert len(read.inputFiles()) == 8
    assert sorted(map(str, read.collect())) == sorted(map(str, run("src_table", spark, sf_dir).collect()))


def test_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "f.csv").write_text('id,note\n1,"a\nb\n2,c\n')
    with pytest.raises(Exception, match="never closed"):
        csv.read_csv_split(spark, str(tmp_path), csv.T.StructType.fromDDL("id int, note string")).collect()


def test_csv_is_split_into_files(spark, tmp_path):
    csv.write_csv(spark.range(0, 100, 1, 1), str(tmp_path / "out"), max_records_per_file=30)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 4


def test_malformed_csv_is_an_error(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,n\nx,1\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        csv.read_csv(spark, str(tmp_path), "id int, n int").collect()


def test_null_if_blank(spark):
    df = spark.createDataFrame([("", float("nan"), 1), ("x", 2.0, None)], "s string, d double, i int")
    assert [tuple(r) for r in csv.null_if_blank(df).collect()] == [(None, None, 1), ("x", 2.0, None)]


# ---- refresh, views, catalog ------------------------------------------------


def test_refresh_replaces_and_reconciles(spark, orders, tmp_path):
    path = str(tmp_path / "t")
    tables.full_refresh(spark.range(5), path)
    tables.full_refresh(orders, path)
    row = tables.reconcile(orders, tables.scan(spark, path)).first()
    assert tuple(row) == (1500, 1500, 0)
    assert tuple(tables.reconcile(orders, orders.where("false")).first()) == (1500, 0, 1500)


def test_database_and_table(spark, orders, tmp_path):
    tables.use_database(spark, "checks", str(tmp_path / "db"))
    try:
        tables.create_table_as(spark.range(3), "t")
        tables.create_table_as(spark.range(4), "t")
        assert tables.scan(spark, "checks.t").count() == 4
    finally:
        spark.catalog.setCurrentDatabase("default")



def test_describe(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in profile.describe(df).collect()] == [(0, "a", "int", "NO"), (1, "b", "string", "YES")]


# ---- updates and increments -------------------------------------------------


def test_update_by_key(spark):
    base = spark.createDataFrame([("1", "a", 1), ("2", "b", 2), ("3", "c", 3), (None, "n", 4)], "k string, v string, w int")
    updates = spark.createDataFrame(
        [("2", "B", 1), ("2", "B2", 2), ("3", None, 1), ("9", "z", 1)], "k string, v string, t int"
    )
    latest = incremental.update_by_key(base, updates, "k", ["v"], "t")
    assert latest.columns == base.columns
    assert sorted(map(tuple, latest.collect()), key=lambda r: r[2]) == [("1", "a", 1), ("2", "B2", 2), ("3", None, 3), (None, "n", 4)]
    assert incremental.update_by_key(base, updates, "k", ["v"]).count() == 4
    tied = spark.createDataFrame([("1", v, 5) for v in ("p", "r", "q")], "k string, v string, t int")
    assert {r.v for r in incremental.update_by_key(base, tied, "k", ["v"], "t").where("k = '1'").collect()} == {"r"}


def test_pending_rows_and_added_column(spark):
    df = spark.createDataFrame([("1", "x"), ("2", ""), ("3", None), ("4", "y")], "order_id string, customer_notes string")
    assert sorted(r.order_id for r in incremental.pending_rows(df).collect()) == ["1", "4"]
    finished = spark.createDataFrame([("4",)], "order_id string")
    assert [r.order_id for r in incremental.pending_rows(df, finished=finished).collect()] == ["1"]
    assert incremental.add_column_if_missing(df, "customer_notes") is df
    assert [r.customer_notes for r in incremental.fill_notes(df.drop("customer_notes")).collect()] == [""] * 4


def test_sample_is_stable(orders):
    first = [r.order_id for r in profile.preview_sample(orders, 5, "order_id", "s").collect()]
    again = [r.order_id for r in profile.preview_sample(orders.repartition(7), 5, "order_id", "s").collect()]
    assert first == again and len(set(first)) == 5
    assert [r.order_id for r in profile.preview_sample(orders, 2, "order_id").collect()] == ["ORD-0000000", "ORD-0000001"]


# ---- anonymized tables ------------------------------------------------------


def test_every_column_has_a_treatment(orders):
    assert set(COLUMN_TREATMENTS) == set(ORDERS_SCHEMA.names) == set(orders.columns)
    assert len(anonymize_orders(orders, POLICY).columns) == 17
    assert set(orders.columns) - set(suppress_columns(orders).columns) == {"full_name", "street_address", "card_last4"}


def test_export_shows_no_raw_value(orders):
    exported = export_orders(orders, POLICY)
    assert "customer_notes" not in exported.columns
    raw = orders.select("order_id", "email", "phone", "full_name", "street_address", "ip_address", "customer_id")
    joined = exported.join(raw, "order_id").collect()
    assert len(joined) == 1500
    for r in joined:
        shown = [v for c, v in r.asDict().items() if c in exported.columns and c != "order_id" and isinstance(v, str)]
        for c in ("email", "full_name", "street_address", "ip_address", "customer_id"):
            assert not r[c] or not any(r[c] in v for v in shown), (c, r)


def test_month_option(orders):
    monthly = anonymize_orders(orders, Policy(noise_salt="s", as_of=POLICY.as_of, order_date_to_month=True))
    assert monthly.where(F.dayofmonth("order_date") != 1).count() == 0


def test_growth_forms_agree(orders):
    view = views.view_geo_analysis(anonymize_orders(orders, POLICY))
    assert sorted(geo.growth_first_last(view).collect()) == sorted(geo.growth_first_last_joined(view).collect())


def test_generated_orders(spark, sf_dir):
    customers = tables.read_test_table(spark, sf_dir, "customer")
    df = gen_orders(customers, POLICY.as_of, "seed")
    assert df.columns == ORDERS_SCHEMA.names
    n, ids = df.agg(F.count("*"), F.countDistinct("order_id")).first()
    assert n == ids and n > 150
    limits = {"VIP": (80, 500), "Regular": (25, 200), "New": (10, 80)}
    for r in df.groupBy("customer_segment").agg(F.min("order_value_eur").alias("a"), F.max("order_value_eur").alias("z")).collect():
        low, high = limits[r.customer_segment]
        assert Decimal(low) <= r.a <= r.z <= Decimal(high)
    first, last = df.agg(F.min("order_date"), F.max("order_date")).first()
    assert dt.datetime(2023, 12, 31) <= first <= last < dt.datetime(2026, 1, 1)
    again = gen_orders(customers.repartition(5), POLICY.as_of, "seed")
    assert df.exceptAll(again).count() == 0


# ---- streams ----------------------------------------------------------------


def test_stream_equals_batch_and_repeats_nothing(spark, orders, tmp_path):
    source, sink, checkpoint = (str(tmp_path / d) for d in ("source", "sink", "checkpoint"))
    parts = [orders.where(F.crc32("order_id") % 3 == i) for i in range(3)]
    for part in parts:
        part.coalesce(2).write.mode("append").parquet(source)
        jobs.anonymize_stream(spark, POLICY, source, sink, checkpoint, max_files_per_trigger=1)
    idle = jobs.anonymize_stream(spark, POLICY, source, sink, checkpoint)
    assert sum(p["numInputRows"] for p in idle.recentProgress) == 0
    got, expected = spark.read.parquet(sink), export_orders(orders, POLICY)
    assert got.count() == 1500 and got.exceptAll(expected.select(got.columns)).count() == 0


def test_stream_goes_on_after_a_failure(spark, orders, tmp_path):
    """A run that dies leaves nothing half done; the next one with the same checkpoint ends whole."""
    source, sink, checkpoint = (str(tmp_path / d) for d in ("source", "sink", "checkpoint"))
    orders.repartition(4).write.parquet(source)

    def failing(df):
        bad = F.col("order_id") == "ORD-0000777"
        return df.select("order_id", F.when(bad, F.raise_error(F.lit("lost"))).otherwise(F.col("city")).alias("city"))

    with pytest.raises(Exception, match="lost"):
        jobs.run_files(spark, failing, source, sink, checkpoint, max_files_per_trigger=1)
    jobs.run_files(spark, lambda df: df.select("order_id", "city"), source, sink, checkpoint, max_files_per_trigger=1)
    got = spark.read.parquet(sink)
    assert got.count() == 1500 == got.select("order_id").distinct().count()


# ---- scratch ----------------------------------------------------------------


def test_shared_folder_comes_from_the_session(spark):
    assert fresh_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_without_a_checkpoint_folder_the_warehouse_is_used():
    settings = {"spark.sql.warehouse.dir": "file:/shared/warehouse"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))
    assert shared_base(session) == "file:/shared/warehouse/anonkit-scratch"
