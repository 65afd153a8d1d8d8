import pytest
from oracle_check import connect, differences

from anonkit.plans.registry import run
from anonkit.session import scale_conf

from __spark_entry__ import oracle_sql


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Tokyo"])
@pytest.mark.parametrize("name", ["anonymize_orders", "ge07_monthly_revenue", "gen_orders", "src_csv_multiline", "cb11_recency_top10"])
def test_results_do_not_depend_on_the_time_zone(name, zone, spark, sf_dir):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert differences(run(name, spark, sf_dir), connect(sf_dir), oracle_sql()[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("name", ["anonymize_orders", "dm07_category_share", "kanon_summary", "age_range"])
def test_results_do_not_depend_on_ansi_mode(name, spark, sf_dir):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert differences(run(name, spark, sf_dir), connect(sf_dir), oracle_sql()[name]) == []
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_partitions_grow_with_the_input_up_to_a_ceiling():
    def numbers(size):
        conf = scale_conf(size)
        return int(conf["spark.sql.shuffle.partitions"]), int(conf["spark.sql.files.maxPartitionBytes"])

    assert numbers(10 * 2**20) == (8, 128 * 2**20)
    assert numbers(2**40) == (820, 128 * 2**20)
    partitions, split = numbers(100 * 2**40)
    assert partitions == 50_000 and 100 * 2**40 / split <= 100_000
