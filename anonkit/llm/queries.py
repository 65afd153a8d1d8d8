"""The registered queries: each operator over its whole table, cut to the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anonkit.llm import (
    centroids,
    decontaminate,
    html_text,
    order_minhash,
    packing,
    prefix_trie,
    quality,
    simhash,
    token_counts,
    topk,
    toxicity,
    url_filters,
    warc,
)
from anonkit.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), "page_id", "url").drop("weight")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark, table(spark, sf_dir, "pages")).drop("url")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return documents.select(
        "doc_id", (F.pmod(crc, F.lit(4)) == 2).alias("held_out"), toxicity.score_column(model, "text").alias("score")
    ).withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("item_ids")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = documents.select("doc_id", quality.score_column(quality.fit(documents), "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), "doc_id", "text")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(table(spark, sf_dir, "conversations"))


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_decontaminate": op2_decontaminate,
    "op3_html_text": op3_html_text,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_simhash": op6_simhash,
    "op7_url_filters": op7_url_filters,
    "op8_warc": op8_warc,
    "op9_topk": op9_topk,
    "op10_token_counts": op10_token_counts,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_order_minhash": op12_order_minhash,
    "op13_centroids": op13_centroids,
}

ORACLE_SQL: dict[str, str] = {
    "op7_url_filters": url_filters.oracle_sql(),
    "op11_prefix_trie": prefix_trie.oracle_sql(),
    "op13_centroids": centroids.oracle_sql(),
}
