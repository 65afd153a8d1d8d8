"""One customer with a third of all orders: whole results, and its join partition is split."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from anonkit.plans.registry import run
from anonkit.sources.orders import orders_flat
from oracle_check import connect, differences

from __spark_entry__ import oracle_sql

SQL = oracle_sql()
AFFECTED = [
    "anonymize_orders",
    "audit_hash_determinism",
    "audit_hash_unique",
    "audit_ip_gain",
    "audit_postal_rare",
    "audit_redaction",
    "cb01_customers",
    "cb04_top5",
    "cb10_best_per_segment",
    "dm10_rank_lag",
    "ge09_growth_first_last",
    "ge10_city_above_avg",
    "hash_group_spend",
    "kanon_4qi",
    "kanon_summary",
    "noise_utility_total",
    "pp10_running_total",
    "profile_dataset",
    "suppress_small_groups",
    "suppress_unique_prefix",
    "upd_by_key",
    "view_customer_behavior",
]


@pytest.fixture(scope="module")
def skewed_dir(spark, sf_dir, tmp_path_factory):
    """The test tables with 60,000 orders, a third of them from customer 7."""
    folder = tmp_path_factory.mktemp("skewed")
    for table in (
        "region nation customer supplier part lineitem events documents embeddings pages benchmark labels conversations"
    ).split():
        (folder / f"{table}.parquet").symlink_to(f"{sf_dir}/{table}.parquet")
    rng = random.Random(11)
    rows = [
        (
            i,
            7 if i % 3 == 0 else rng.randrange(150),
            "O",
            round(rng.uniform(900, 400000), 2),
            dt.datetime(1995, 1, 1) + dt.timedelta(days=rng.randrange(900)),
            rng.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
        )
        for i in range(60_000)
    ]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    schema += " o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).repartition(8).write.parquet(str(folder / "orders_parts"))
    (folder / "orders.parquet").symlink_to(folder / "orders_parts")
    return str(folder)


@pytest.fixture(scope="module")
def duck(skewed_dir, sf_dir):
    connection = connect(sf_dir)
    connection.execute(f"CREATE OR REPLACE VIEW orders AS SELECT * FROM '{skewed_dir}/orders_parts/*.parquet'")
    return connection


@pytest.mark.parametrize("name", AFFECTED)
def test_result_is_whole(name, spark, skewed_dir, duck):
    assert differences(run(name, spark, skewed_dir), duck, SQL[name]) == []


def test_hot_customer_is_split_in_the_join(spark, skewed_dir):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        df = orders_flat(spark, skewed_dir).select("order_id", "country")
        assert len({r.order_id for r in df.collect()}) == 60_000
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in text
        # and with an aggregation on the customer behind the join
        df = orders_flat(spark, skewed_dir).groupBy("customer_id").agg(F.count("*").alias("n"))
        assert df.agg(F.max("n")).first()[0] > 20_000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
