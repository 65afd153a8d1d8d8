"""The pipeline's stages on planted documents, and its result against the stages' operators."""

from __future__ import annotations

import corpus_pipeline
from anonkit.llm import decontaminate, packing, quality, simhash, toxicity
from anonkit.llm.common import table


def test_stages_keep_columns_and_their_decisions_take_effect(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    labels, items = table(spark, sf_dir, "labels"), table(spark, sf_dir, "benchmark")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        assert made.columns == docs.columns, name
        kept = {r.doc_id for r in made.select("doc_id").collect()}
        texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        if name == "toxicity":
            model = toxicity.fit(docs, labels)
            assert kept == {k for k, t in texts.items() if model.score(t) < toxicity.THRESHOLD}
        elif name == "quality_classifier":
            scores = quality.fit(docs).scores(list(texts.values()))
            assert kept == {k for k, s in zip(texts, scores, strict=True) if s >= quality.THRESHOLD}
        elif name == "simhash_near_dedup":
            assert kept == {r.component_id for r in simhash.simhash_components(docs, "doc_id", "text").collect()}
        else:
            found = decontaminate.find_contamination(docs, items).where("not contaminated")
            assert kept == {r.doc_id for r in found.collect()}
        assert made.count() == len(kept) < len(texts), name
        docs = made


def test_run_packs_what_the_stages_keep(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    want = {(r.doc_id, r.doc_tokens) for r in packing.pack_documents(docs, "doc_id", "text").collect()}
    assert {(r.doc_id, r.doc_tokens) for r in corpus_pipeline.run(spark, sf_dir).collect()} == want


def test_stages_on_odd_and_empty_tables(spark, sf_dir, odd_documents):
    for docs in (odd_documents, odd_documents.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
            assert stage(spark, docs, sf_dir).count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()


def test_batches_of_long_texts_are_bounded_by_bytes(spark, sf_dir):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from anonkit.llm.common import BATCH_BYTES

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(2000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 300).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]}, schema=pa.schema([("n", pa.int64()), ("bytes", pa.int64())]))

    def seen():
        return [(r.n, r.bytes) for r in docs.mapInArrow(sizes, "n bigint, bytes bigint").collect()]

    spark.conf.unset(limit)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(limit)
            stage(spark, docs.limit(0), sf_dir)
            found = seen()
            assert sum(n for n, _ in found) == 2000
            assert max(b for _, b in found) < 2 * BATCH_BYTES
        spark.conf.set(limit, str(1 << 29))
        corpus_pipeline.pack(spark, docs, sf_dir)
        assert spark.conf.get(limit) == str(1 << 29)  # a limit that the session has is kept
    finally:
        spark.conf.unset(limit)


def test_features_counted_in_parts_score_alike(spark):
    rows = [(f"shared word{i % 7} {'bad' if i % 2 else 'fine'}{i % 5} extra{i}", bool(i % 2), 1.0) for i in range(400)]
    sample = spark.createDataFrame(rows, "text string, toxic boolean, weight double").coalesce(1)
    whole = toxicity.feature_scores(sample, 0.5, 10_000)
    rows_limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(rows_limit, "20")
    try:
        assert whole and toxicity.feature_scores(sample, 0.5, 10_000, counted_features=50) == whole
    finally:
        spark.conf.unset(rows_limit)
