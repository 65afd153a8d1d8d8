"""The physical plans: native operators only, pruned scans, limits before shuffles, no needless scans."""

import re

import pytest
from pyspark.sql import functions as F

from anonkit.operators import kanon
from anonkit.operators.anonymize import anonymize_orders
from anonkit.plans import demographic, geo, views
from anonkit.plans.registry import POLICY, QUERIES, Inputs, run

# these write tables before they return, so their plan is only the final read
WRITERS = {n for n in QUERIES if n.startswith(("sink_", "stream_"))} | {"src_csv_multiline", "inc_checkpoint", "cat_use_db"}
FORBIDDEN = r"EvalPython|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin|ExistingRDD"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_native_operators_only(name, spark, sf_dir):
    assert not re.search(FORBIDDEN, plan(run(name, spark, sf_dir)))


def test_masking_needs_no_shuffle(spark, sf_dir):
    text = plan(run("export_orders", spark, sf_dir))
    assert "Exchange hashpartitioning" not in text and text.count("Exchange") == text.count("BroadcastExchange")


def test_scan_reads_the_columns_of_the_question(spark, sf_dir):
    text = plan(run("ge01_payment_counts", spark, sf_dir))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in text


def test_filter_reaches_the_scan_through_view_and_group(spark, orders, tmp_path):
    path = str(tmp_path / "anon")
    anonymize_orders(orders, POLICY).write.parquet(path)
    view = views.view_demographic_analysis(spark.read.parquet(path))
    text = plan(demographic.orders_in_country(view))
    assert "EqualTo(country,Spain)" in text
    assert "order_value_random" not in re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)


def test_best_per_segment_is_limited_before_the_shuffle(spark, sf_dir):
    text = final_plan(run("cb10_best_per_segment", spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


@pytest.mark.parametrize("name", ["cb04_top5", "cb11_recency_top10", "postal_distribution", "preview_sample"])
def test_top_k_does_not_sort_everything(name, spark, sf_dir):
    text = plan(run(name, spark, sf_dir))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["kanon_summary", "ge09_growth_first_last"])
def test_one_scan_of_the_orders(name, spark, sf_dir):
    assert plan(run(name, spark, sf_dir)).count("orders.parquet") == 1


def test_coarse_sets_of_all_views_share_a_scan(spark, sf_dir):
    assert plan(run("kanon_view", spark, sf_dir)).count("orders.parquet") == 3


def test_the_median_gathers_no_values_in_one_task(spark, sf_dir):
    text = final_plan(run("noise_utility_total", spark, sf_dir))
    assert "percentile" not in text and "ObjectHashAggregate" not in text and "orders.parquet" not in text


def test_both_forms_of_growth_agree(spark, sf_dir):
    view = QUERIES["view_geo_analysis"](Inputs(spark, sf_dir))
    first, second = (sorted(map(str, f(view).collect())) for f in (geo.growth_first_last, geo.growth_first_last_joined))
    assert first == second


@pytest.mark.parametrize("name", ["ge10_city_above_avg", "profile_dataset"])
def test_shared_aggregates_are_shuffled_once(name, spark, sf_dir):
    assert "ReusedExchange" in final_plan(run(name, spark, sf_dir))


def test_distinct_people_are_spread_by_group_and_person(orders):
    qi = kanon.with_quasi_identifiers(orders, POLICY)
    text = plan(kanon.group_sizes(qi, ["gender", "country"]))
    first_shuffle = re.findall(r"hashpartitioning\(([^)]*)\)", text)[-1]
    assert "customer_id" in first_shuffle
    assert text.count("HashAggregate") == 4 and "SortAggregate" not in text


def test_a_filter_on_redacted_text_keeps_the_plan_small(orders):
    from anonkit.operators.redact import redact_column

    redacted = redact_column(orders.select("customer_notes"), "customer_notes", "r")
    text = plan(redacted.where((F.col("r") != F.col("customer_notes")) & F.col("r").isNotNull()))
    assert len(text) < 200_000


def test_notes_are_derived_once(spark, sf_dir):
    plan = Inputs(spark, sf_dir).texts()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("called from") == 1
