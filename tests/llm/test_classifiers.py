"""Toxicity and quality: held-out accuracy, parts against brute force, odd tables."""

from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from anonkit.llm import quality, toxicity
from anonkit.llm.common import table
from anonkit.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.1"


# ---- segments ---------------------------------------------------------------


def brute_segments(scores, low, high):
    """Ruzzo and Tompa's definition: take the best segment (shortest on ties), then both sides of it."""
    best = None
    for a, b in itertools.combinations(range(low, high + 1), 2):
        s = sum(scores[a:b])
        if s > 0 and (best is None or (s, a - b) > (best[2], best[0] - best[1])):
            best = (a, b, s)
    if best is None:
        return []
    return brute_segments(scores, low, best[0]) + [best] + brute_segments(scores, best[1], high)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-1000, 1000).filter(bool), max_size=14, unique_by=abs))
def test_segments_are_the_maximal_ones(values):
    scores = [v + 2.0 ** -(i + 2) for i, v in enumerate(values)]  # no two sums are equal
    assert toxicity.segments(np.array(scores)) == [pytest.approx(s) for s in brute_segments(scores, 0, len(scores))]


def test_segments_of_a_long_text_are_found_in_one_pass():
    scores = np.where(np.arange(600_000) % 3 == 0, 1.0, -0.4)
    assert toxicity.segments(scores) == [(0, 599_998, pytest.approx(200_000 - 0.4 * 399_998))]
    falling = np.where(np.arange(400_000) % 2 == 0, 1.0, -2.0)
    assert len(toxicity.segments(falling)) == 200_000


# ---- toxicity ---------------------------------------------------------------


def test_op1_is_accurate_on_held_out_documents(spark):
    rows = QUERIES["op1_toxicity"](spark, LARGER).collect()
    labels = {r.doc_id: r.toxic for r in table(spark, LARGER, "labels").collect()}
    assert len(rows) == table(spark, LARGER, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    right = sum(p and t for p, t in judged)
    assert right / sum(t for _, t in judged) > 0.8
    assert right / sum(p for p, _ in judged) > 0.85


def test_toxic_passages_are_named(spark):
    rows = [(i, f"calm words number {i} about rivers and hills " * 3 + ("vile slur" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    text = "calm words about hills " * 10 + "vile slur" + " rivers and words" * 10
    assert [(a, b) for a, b, _ in toxicity.passages(model, text)] == [(40, 42)]
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {r[0] for r in rows if not r[2]}


def test_toxicity_of_odd_tables(spark, odd_documents):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (5, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd_documents, labels)
    assert {r[0] for r in odd_documents.select(toxicity.score_column(model, "text")).collect()} == {0.0}
    kept = toxicity.drop_toxic(odd_documents, model)
    assert kept.columns == odd_documents.columns and kept.count() == 8
    assert toxicity.drop_toxic(odd_documents.limit(0), toxicity.fit(odd_documents.limit(0), labels.limit(0))).count() == 0
    evident = toxicity.SegmentModel({"bad": 9.0}, 1.0, 0.05, 1.0, -3.0)
    scores = [evident.score(t) for t in (None, "", " \n", "good", "bad", "bad bad")]
    assert scores[0] == scores[1] == scores[2] == scores[3] < scores[4] and all(0 <= s <= 1 for s in scores)


# ---- quality ----------------------------------------------------------------


def test_op5_agrees_with_the_true_labels(spark):
    rows = {r.doc_id: r for r in QUERIES["op5_quality"](spark, LARGER).collect()}
    labels = [(rows[r.doc_id].predicted, r.quality) for r in table(spark, LARGER, "labels").collect() if r.quality is not None]
    good = [p for p, q in labels if q == 1]
    junk = [p for p, q in labels if q == 0]
    assert sum(good) / len(good) > 0.99 and 1 - sum(junk) / len(junk) > 0.9


def test_estimate_finds_accuracies_without_labels():
    """Votes drawn from known accuracies."""
    rng = np.random.default_rng(4)
    n, k = 30_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.85
    says_good = np.stack([np.linspace(0.3, 0.8, k), np.full(k, 0.999)], axis=1)
    votes = np.where(rng.random((n, k)) < says_good[:, good.astype(int)].T, quality.GOOD, quality.JUNK)
    votes[rng.random((n, k)) < 0.2] = quality.SILENT
    numbers, counts = np.unique([quality.pattern_number(tuple(v)) for v in votes], return_counts=True)
    model = quality.estimate(numbers, counts.astype(float))
    assert abs(model.good - 0.85) < 0.02
    assert np.abs(model.says_good[:, 0] - says_good[:, 0]).max() < 0.05
    assert (quality.pattern_votes(numbers) == [list(v) for v in quality.pattern_votes(numbers)]).all()
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.95


def test_linear_scorer_solves_its_equations():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.random((400, 6)), np.ones((400, 1))], axis=1)
    target = 1 / (1 + np.exp(-(x @ rng.normal(size=7))))
    w = quality.fit_linear(x, target)
    shrink = np.full(7, 0.1)
    shrink[-1] = 1e-3
    assert np.abs(x.T @ (target - 1 / (1 + np.exp(-x @ w))) - shrink * w).max() < 1e-3


@pytest.mark.parametrize(("word", "shown"), [("Word,", "Aa,"), ("WORD!!", "A!!"), ("a1b", "a9a"), ("x$$$$", "a$$"), ("|", "|"), ("é.", "a.")])
def test_shapes(word, shown):
    assert quality.describe(word)[0] == shown


def test_quality_of_odd_tables(spark, odd_documents):
    model = quality.fit(odd_documents)
    rows = odd_documents.select("text", quality.score_column(model, "text").alias("p")).collect()
    assert all(0 <= r.p <= 1 and math.isfinite(r.p) for r in rows)
    assert len({r.p for r in rows if not (r.text or "").strip()}) == 1
    assert quality.drop_junk(odd_documents, model).columns == odd_documents.columns
    empty = odd_documents.limit(0)
    assert quality.drop_junk(empty, quality.fit(empty)).count() == 0


def test_words_described_in_bulk_as_one_by_one():
    rng = np.random.default_rng(2)
    signs = [chr(c) for c in range(0x21, 0x300) if not chr(c).isspace()] + ["\u4e2d", "\u00e9", "\u01c5", "\u0130", "\U0001f600"]
    words = ["".join(rng.choice(signs, rng.integers(1, 6))) for _ in range(20_000)]
    words += [w + e for w in ("Word", "WORD", "word", "W", "w", "wOrd", "\u01c5A", "\u00aaB", "\u00df") for e in ("", ".", ",", ";", ":", "!", "?", "..", "-")]
    shapes = quality.TextShapes()
    attributes, bucket = shapes._describe(words)
    for i, word in enumerate(words):
        shape, *rest = quality.describe(word)
        assert (bucket[i], attributes[i].tolist()) == (zlib.crc32(shape.encode()), [float(x) for x in rest]), word


def small_model():
    return toxicity.SegmentModel({w: 3.0 for w in ("vile", "foul", "grim", "nasty")}, rate=1.0, scale=0.05, weight=2.0, bias=-3.0)


def test_a_dense_passage_counts_whatever_stands_before():
    model = small_model()
    clean = ["plain"] * 300
    dense = ["vile", "foul", "grim", "nasty"]
    alone = model.score(" ".join(clean + dense + clean))
    scattered = [w for d in dense for w in [d, *["plain"] * 100]]
    both = model.score(" ".join(scattered + clean[: 600 - len(scattered)] + dense))
    assert both >= alone > toxicity.THRESHOLD
    text = " ".join(scattered + dense + clean + dense)
    found = [(a, b) for a, b, _ in toxicity.passages(model, text)]
    words = text.split()
    assert [words[a:b] for a, b in found if b - a > 1] == [dense, dense]


def test_repetition_proves_nothing():
    model = small_model()
    once = model.score(" ".join(["vile", *["plain"] * 99] * 1 + ["plain"] * 900))
    often = model.score(" ".join(["vile", *["plain"] * 99] * 10))
    assert abs(often - once) < 1e-9
    assert model.score("vile " * 50 + "plain " * 950) <= once + 1e-9


def test_score_from_segments_by_hand():
    model = small_model()
    words = "plain vile foul plain plain plain plain plain vile grim plain".split()
    scores = [2.0 if w in model.scores else -1.0 for w in words]
    scores[8] = -1.0  # vile, said before
    assert model.token_scores([w.encode() for w in words]).tolist() == scores
    assert sorted(toxicity.segments(np.array(scores))) == [(1, 3, 4.0), (9, 10, 2.0)]
    surprises = []
    for r, s in ((1, 4.0), (2, 2.0)):
        e = 0.05 * len(words) * math.exp(-s)
        surprises.append(e - r + r * (math.log(r) - math.log(e)) if r > e else 0.0)
    evidence = math.log1p(max(surprises))
    assert math.isclose(model.text_evidence(" ".join(words)), evidence)
    assert math.isclose(model.score(" ".join(words)), 1 / (1 + math.exp(3 - 2 * evidence)))


def test_rare_toxic_labels_still_teach(spark):
    rng = np.random.default_rng(1)
    filler = [f"word{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(filler, 60)) + (" vile foul grim nasty horrid" * 2 if i % 400 == 3 else "")) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 400 == 3).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels, sample_rows=400)
    found = {r.doc_id for r in docs.where(toxicity.score_column(model, "text") >= toxicity.THRESHOLD).select("doc_id").collect()}
    assert found == {i for i in range(4000) if i % 400 == 3}
