"""From raw documents to packed training sequences: five stages, each a DataFrame of its predecessor's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from anonkit.llm import decontaminate, packing, quality, simhash, toxicity
from anonkit.llm.common import bound_batches, ship_package, table, written


def ready(spark: SparkSession) -> None:
    """What each stage needs of the session: the package on the executors, and batches of texts bounded by bytes."""
    ship_package(spark)
    bound_batches(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the maximum-scoring segments do not show as toxic."""
    ready(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer, taught by the weak labels, takes for good."""
    ready(spark)
    return quality.drop_junk(docs, quality.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that fingerprints of four-word shingles within four bits join."""
    ready(spark)
    return simhash.keep_one_per_group(docs, "doc_id", "text")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item."""
    ready(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    ready(spark)
    return packing.pack_documents(docs, "doc_id", "text")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_classifier", drop_junk),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: Trained models and packing cannot be said in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a Parquet table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
