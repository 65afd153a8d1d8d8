"""Toxicity as significant maximum-scoring segments of a text.

Each token has a log-odds score of toxic against clean, learned from labelled texts. Counts of a word are
smoothed by those of its prefixes in a chain of Dirichlet priors (two classes, so Beta): the expected rate
of a prefix is the prior of the next longer one, the longest one that of the word. A fixed drag is taken
off each token, so clean text scores below zero on average. A linear scan then finds all maximal
scoring segments (each run whose sum no longer or shorter run beats). Their scores follow an
extreme-value law: in n tokens of clean text a score of S or more is expected ``scale * n * exp(-rate * S)``
times. Scale and rate are the maximum-likelihood fit to the segments of clean texts that the word counts
have not seen. The evidence of a text is how surprising its best segments are together; a logistic curve,
fitted on labelled texts that the counts have not seen either, turns it into a probability.

Mere repetition proves nothing: a word scores above zero only if it did not just before (``REACH`` words), and in the
evidence of several segments each word counts in the best segment that holds it. So every passage is scored by
itself, whatever stands before it, and more evidence never makes a text look cleaner.

The model is fitted on a bounded sample of labelled texts (``sample_rows``, half of each class, weighted by how many labelled
texts each stands for) and holds at most ``most_features`` words and prefixes. Scoring is a projection over all rows.

Defined cases: null, empty and wordless texts get the score of no evidence; without labelled texts of
both classes every score is 0; where a class is too small to be parted, all rows serve both counts and curve; labels that are null are left out, of several labels of a key the largest
counts; repeated rows score alike; an empty table gives no rows; other columns have no effect.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anonkit.llm.common import map_rows, pa_schema, word_bytes, written

PREFIXES = (3, 4, 5, 6)  # characters
PRIOR = 4.0
DRAG = 1.0
THRESHOLD = 0.3
REACH = 64  # words
_MEMO_WORDS = 200_000
COUNTED_FEATURES = 100_000


def chain(word: str) -> list[str]:
    """Features of a word from the shortest prefix to the word; prefixes end in ``*``."""
    return [word[:k] + "*" for k in PREFIXES if len(word) > k] + [word]


def words_of(text: str | None) -> list[bytes]:
    return word_bytes(text.lower() if text else text)


@dataclass
class SegmentModel:
    """Feature scores, the rate of the extreme-value law, and the curve from evidence to probability."""

    scores: dict[str, float]
    rate: float = 1.0
    scale: float = 1.0
    weight: float = 0.0
    bias: float = -math.inf
    memo: dict[bytes, float] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def word_score(self, word: bytes) -> float:
        features = chain(word.decode("utf-8", "replace"))
        return next((self.scores[f] for f in reversed(features) if f in self.scores), 0.0) - DRAG

    def token_scores(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > _MEMO_WORDS:
            memo.clear()
        for word in set(words).difference(memo):
            memo[word] = self.word_score(word)
        scores = np.fromiter(map(memo.__getitem__, words), float, len(words))
        last: dict[bytes, int] = {}
        for i in np.flatnonzero(scores > 0).tolist():
            if i - last.get(words[i], -REACH - 1) <= REACH:
                scores[i] = -DRAG
            last[words[i]] = i
        return scores

    def evidence(self, scores: np.ndarray, words: list[bytes]) -> float:
        """log(1 + surprise), with the surprise of the best r segments, for the r that gives most.

        The r-th best score S is reached by chance ``E = scale * n * exp(-rate * S)`` times; r or more times
        has a probability of at most ``exp(r - E) * (E / r) ** r`` (Chernoff bound of the Poisson law). Of a segment
        behind the best one, words that a better one holds count nothing.
        """
        found = sorted(segments(scores), key=lambda s: (-s[2], s[0]))
        if not found:
            return 0.0
        counted: set[bytes] = set()
        own = []
        for start, end, total in found:
            good = (start + np.flatnonzero(scores[start:end] > 0)).tolist()
            total -= sum(float(scores[i]) for i in good if words[i] in counted)
            counted.update(words[i] for i in good)
            if total > 0:
                own.append(total)
        best = np.sort(own)[::-1]
        r = np.arange(1, len(best) + 1)
        log_expected = math.log(self.scale * len(scores)) - self.rate * best
        expected = np.exp(np.minimum(log_expected, 50))
        surprise = np.where(r > expected, expected - r + r * (np.log(r) - log_expected), 0.0)
        return math.log1p(float(surprise.max()))

    def text_evidence(self, text: str | None) -> float:
        words = words_of(text)
        return self.evidence(self.token_scores(words), words)

    def probability(self, evidence: float) -> float:
        if self.bias == -math.inf:
            return 0.0
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.bias + self.weight * evidence))))

    def score(self, text: str | None) -> float:
        return self.probability(self.text_evidence(text))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in one pass.

    A candidate keeps the running sum before (low) and after it (high), and the nearest earlier candidate
    with a smaller low. A new one joins back to that candidate while its own high is the greater.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, low, high = i, float(sums[i]), float(sums[i + 1])
        while True:
            back = len(found) - 1
            while back >= 0 and found[back][2] >= low:
                back = found[back][4]
            if back < 0 or found[back][3] >= high:
                break
            start, low = found[back][0], found[back][2]
            del found[back:]
        found.append((start, i + 1, low, high, back))
    return [(start, end, high - low) for start, end, low, high, _ in found]


# ---- fitting ----------------------------------------------------------------


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample_rows: int) -> DataFrame:
    """At most about ``sample_rows`` labelled texts outside the held-out quarter, chosen by a hash of the key, half of each class.

    ``weight`` is how many labelled texts a row stands for, on average 1. A quarter (``curve``) is kept from the counts, for the
    rate and the curve. Written as a table.
    """
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (F.pmod(crc, F.lit(4)) != 2))
        .groupBy(F.col(key).alias("key"))
        .agg((F.max(label).cast("int") == 1).alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    steps = {toxic: max(1, -(-n // max(1, sample_rows // 2))) for toxic, n in sizes.items()}
    if sum(sizes.values()) <= sample_rows:
        steps = dict.fromkeys(sizes, 1)
    step = F.when(F.col("toxic"), steps.get(True, 1)).otherwise(steps.get(False, 1))
    # bounded: one in ``step`` of the keys of a class, so about sample_rows rows
    chosen = F.broadcast(known.where(F.pmod(F.xxhash64("key"), step) == 0))
    sample = (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .join(chosen, "key")
        .groupBy("key", "toxic")
        .agg(F.min("text").alias("text"))
    )
    kept = sum(n / steps[toxic] for toxic, n in sizes.items()) or 1.0
    weight = (step * F.lit(kept / max(1, sum(sizes.values())))).cast("double").alias("weight")
    curve = F.pmod(F.xxhash64("key", F.lit("curve")), F.lit(4)) == 0
    return written(sample.select("key", "text", "toxic", curve.alias("curve"), weight), "toxic")


def feature_scores(
    sample: DataFrame, base: float, most_features: int, counted_features: int = COUNTED_FEATURES
) -> dict[str, float]:
    """Log-odds of the features that say something other than their prior; the clearest ``most_features``.

    A task hands its counts on when they are of over ``counted_features`` features.
    """
    target = pa_schema("root string, feature string, toxic double, n double")
    kept = pa_schema("feature string, score double, weight double")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: defaultdict[str, float] = defaultdict(float)
        n: defaultdict[str, float] = defaultdict(float)

        def counted() -> pa.RecordBatch:
            names = list(n)
            root = [f[: PREFIXES[0]] for f in names]
            columns = (root, names, [toxic.get(f, 0.0) for f in names], list(n.values()))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

        for batch in batches:
            for text, bad, weight in zip(*(batch.column(k).to_pylist() for k in ("text", "toxic", "weight")), strict=True):
                words = [w.decode("utf-8", "replace") for w in set(words_of(text))]
                for feature in {f for w in words for f in chain(w)}:
                    n[feature] += weight
                    if bad:
                        toxic[feature] += weight
            if len(n) > counted_features:
                yield counted()
                toxic.clear()
                n.clear()
        if n:
            yield counted()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: defaultdict[str, float] = defaultdict(float)
        n: defaultdict[str, float] = defaultdict(float)
        for batch in batches:
            for name, t, c in zip(*(batch.column(k).to_pylist() for k in ("feature", "toxic", "n")), strict=True):
                toxic[name] += t
                n[name] += c
        rates: dict[str, float] = {}
        out: list[tuple[str, float, float]] = []
        for name in sorted(n, key=lambda f: (not f.endswith("*"), len(f))):
            above = chain(name.removesuffix("*"))[:-1]
            prior = next((rates[f] for f in reversed(above) if f in rates), base)
            rates[name] = rate = (toxic[name] + PRIOR * prior) / (n[name] + PRIOR)
            score, expected = (math.log(r / (1 - r)) - math.log(base / (1 - base)) for r in (rate, prior))
            if max(score, expected) > DRAG / 2 and abs(score - expected) > 0.2:
                out.append((name, score, abs(score - expected) * n[name]))
        columns = zip(*out, strict=True) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kept, strict=True)], schema=kept)

    counted = sample.select("text", "toxic", "weight").mapInArrow(count, "root string, feature string, toxic double, n double")
    weighed = counted.repartition("root").mapInArrow(weigh, "feature string, score double, weight double")
    rows = weighed.orderBy(F.desc("weight"), "feature").limit(most_features).collect()
    return {r.feature: r.score for r in rows}


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weight and bias of a logistic curve over the evidence; slightly ridged, so separable data stay finite."""
    x = np.stack([evidence, np.ones(len(evidence))], axis=1)
    w, ridge = np.zeros(2), np.diag([0.05, 0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (toxic - p)) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    *,
    sample_rows: int = 20_000,
    most_features: int = 50_000,
) -> SegmentModel:
    """Learn the model; what reaches the driver is bounded by the two limits."""
    sample = training_rows(docs, labels, key, text, label, sample_rows)
    sums = sample.groupBy("toxic", "curve").agg(F.sum("weight").alias("weight")).collect()
    weights = {(r["toxic"], r["curve"]): r["weight"] for r in sums}
    model = SegmentModel({})
    if len({toxic for toxic, _ in weights}) < 2:
        return model
    parted = len(weights) == 4  # else a class is too small to be parted, and all rows serve both
    taught = {toxic: weights.get((toxic, False), 0.0) + (0.0 if parted else weights.get((toxic, True), 0.0)) for toxic in (False, True)}
    rows = sample.where("not curve") if parted else sample
    model.scores = feature_scores(rows, taught[True] / sum(taught.values()), most_features)

    def tally(texts: pa.Array) -> dict[str, object]:
        scores = [model.token_scores(words_of(t)) for t in texts.to_pylist()]
        found = [[s for _, _, s in segments(x)] for x in scores]
        return {"n": [len(x) for x in scores], "count": list(map(len, found)), "total": [float(sum(f)) for f in found]}

    unseen = sample.where("curve") if parted else sample
    tallied = map_rows(unseen.where("not toxic"), ["text"], tally, "n bigint, count bigint, total double")
    n, count, total = tallied.agg(F.sum("n"), F.sum("count"), F.sum("total")).first()
    model.rate, model.scale = (count + 1) / (total + 1), (count + 1) / (n + 1)

    def weigh(texts: pa.Array, toxic: pa.Array, weights: pa.Array) -> dict[str, object]:
        return {"evidence": [model.text_evidence(t) for t in texts.to_pylist()], "toxic": toxic, "weight": weights}

    rows = map_rows(unseen, ["text", "toxic", "weight"], weigh, "evidence double, toxic boolean, weight double").collect()
    weighed = np.array(sorted(tuple(r) for r in rows), float)  # in a fixed order, so that sums come out alike
    model.weight, model.bias = fit_curve(weighed[:, 0], weighed[:, 1], weighed[:, 2])
    return model


def score_column(model: SegmentModel, text: Column | str) -> Column:
    """Probability of each text to be toxic."""

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in texts.to_pylist()], pa.float64())

    return scores(text)


def passages(model: SegmentModel, text: str) -> list[tuple[int, int, float]]:
    """Significant passages of one text as (first word, word after the last, evidence)."""
    scores = model.token_scores(words_of(text))
    chance = math.log(model.scale * max(1, len(scores)))
    return [(a, b, model.rate * s - chance) for a, b, s in segments(scores) if model.rate * s > chance]


def drop_toxic(docs: DataFrame, model: SegmentModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    return docs.where(score_column(model, text) < threshold)
