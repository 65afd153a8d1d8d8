"""Quality from weak labels: heuristic labellers, their estimated accuracies, and a hashed linear scorer.

Labellers look at one property of a text each and vote junk, good, or not at all. Votes of all rows are
counted by pattern (each labeller's vote); expectation-maximisation on these counts estimates how often
each labeller votes what on good and on junk texts, without any true label. That gives each pattern the
posterior probability to be good. A linear scorer over hashed features of token shapes then learns these
posteriors, so that texts no labeller speaks about are judged as well.

The pattern counts are bounded (three votes to the power of the labellers) and cover all rows. The scorer
is fitted on a bounded sample of rows (``sample_rows``); scoring is a projection over all rows.

Defined cases: null, empty and blank texts get no vote and the score of the bias alone; if the labellers
find no junk, all texts get the posterior of their votes alike and are kept; repeated rows score alike;
an empty table gives no rows; other columns have no effect.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anonkit.llm.common import map_rows, pa_schema, written

BUCKETS = 512
THRESHOLD = 0.5
FALSE_ALARM = 0.002
MISSED_KIND = 0.05
GOOD, JUNK, SILENT = 1, 2, 0
LABELLERS = ("bars", "signs", "repeats", "capitals", "sentence_ends", "variety", "letters", "word_length")
_MEMO_WORDS = 150_000
_LETTERS, _DIGITS, _SAME = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(\W)\1+")


def _case(letters: str) -> str:
    return "a" if not letters[0].isupper() else "A" if len(letters) > 1 and letters.isupper() else "Aa"


def shape(word: str) -> str:
    """A word with its letters as A, Aa or a, digits as 9, and signs as they are, at most two of a kind."""
    letters = _LETTERS.sub(lambda m: _case(m[0]), word)
    return _SAME.sub(r"\1\1", _DIGITS.sub("9", letters))[:12]


def describe(word: str) -> tuple[str, float, float, float, float, float, float]:
    """Shape; then whether a bar, characters that are signs, capital word, ends a clause, letters, length."""
    n = len(word)
    ends = word[-1] in ".,;:!?"
    stem = word[:-1] if ends else word
    if stem.isalpha():  # most words
        case = _case(stem)
        return (case + word[-1] if ends else case, 0, 0, case == "A", ends, len(stem), n)
    letters = sum(map(str.isalpha, word))
    signs = sum(c in "#$%&*<>=@^_{}~\\|" for c in word)
    return shape(word), word == "|", signs, letters > 1 and word.isupper(), ends, letters, n


_PLAIN_BELOW = 0x250
_ENDS = ".,;:!?"


def _plain_letters() -> dict[str, np.ndarray]:
    """What Python says of each code point below ``_PLAIN_BELOW``; the last entry stands for all others."""
    points = [chr(p) for p in range(_PLAIN_BELOW)]
    tests = {"letter": str.isalpha, "upper": str.isupper, "lower": lambda c: c.islower() or c.istitle() and not c.isupper()}
    return {name: np.array([*map(test, points), False]) for name, test in tests.items()}


class TextShapes:
    """Per text: the labellers' votes and the shares of its hashed shapes."""

    def __init__(self):
        self.plain = _plain_letters()
        cases = [f"{case}{end}" for case in ("a", "A", "Aa") for end in ("", *_ENDS)]
        self.case_bucket = np.array([zlib.crc32(c.encode()) for c in cases], np.int64)
        self._forget()

    def _forget(self) -> None:
        # a word that is new takes the next number
        self.place: defaultdict[str, int] = defaultdict(count().__next__)
        self.attributes = np.zeros((0, 6), np.float32)
        self.bucket = np.zeros(0, np.int64)

    def _describe(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Attributes and shape hash of words: as ``describe`` gives them, for plain letters with one sign behind in bulk."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        points = np.minimum(np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4"), _PLAIN_BELOW)
        begin = np.cumsum(size) - size
        end = points[begin + size - 1]
        sign = np.zeros(len(words), np.int64)
        for i, mark in enumerate(_ENDS):
            sign[end == ord(mark)] = i + 1
        letters = np.add.reduceat(self.plain["letter"][points], begin, dtype=np.int64)
        stem = size - (sign > 0)
        easy = (stem > 0) & (letters == stem)
        shouted = ~np.logical_or.reduceat(self.plain["lower"][points], begin)
        shouted &= np.logical_or.reduceat(self.plain["upper"][points], begin)
        case = np.where(~self.plain["upper"][points[begin]], 0, np.where((stem > 1) & shouted, 1, 2))
        attributes = np.zeros((len(words), 6), np.float32)
        attributes[:, 2], attributes[:, 3], attributes[:, 4], attributes[:, 5] = case == 1, sign > 0, stem, size
        bucket = self.case_bucket[case * (len(_ENDS) + 1) + sign]
        for i in np.flatnonzero(~easy).tolist():
            made = describe(words[i])
            attributes[i], bucket[i] = made[1:], zlib.crc32(made[0].encode())
        return attributes, bucket

    def words(self, texts: list[str | None]) -> list[np.ndarray]:
        """Numbers of the words of each text; equal words have equal numbers."""
        if len(self.place) > _MEMO_WORDS:
            self._forget()
        known, rows = len(self.place), []
        for text in texts:
            row = (text or "").split()
            rows.append(np.fromiter(map(self.place.__getitem__, row), np.int64, len(row)))
        if fresh := list(islice(reversed(self.place), len(self.place) - known)):
            attributes, bucket = self._describe(fresh[::-1])
            self.attributes = np.concatenate([self.attributes, attributes])
            self.bucket = np.concatenate([self.bucket, bucket])
        return rows

    def votes(self, words: np.ndarray) -> tuple[int, ...]:
        n = len(words)
        if n < 5:
            return (SILENT,) * len(LABELLERS)
        bars, signs, capitals, ends, letters, length = self.attributes[words].sum(axis=0)
        repeats = float((words[1:] == words[:-1]).sum())
        distinct = len(np.unique(words))

        def vote(junk: bool, good: bool) -> int:
            return JUNK if junk else GOOD if good else SILENT

        return (
            vote(bars > 0.05 * n, bars == 0 and n > 20),
            vote(signs - bars > 0.05 * length, signs <= 0.01 * length),
            vote(repeats > 0.2 * n and repeats > 3, repeats <= 0.05 * n and n > 20),
            vote(capitals > 0.4 * n and n > 10, capitals <= 0.1 * n),
            vote((ends > 0.6 * n or ends < 0.03 * n) and n > 30, 0.06 * n < ends < 0.3 * n),
            vote(distinct < 0.35 * n and 30 < n < 3000, distinct > 0.5 * n),
            vote(letters < 0.85 * length and n > 30, letters > 0.93 * length),
            vote((length > 8.5 * n or length < 3 * n) and n > 30, 4 * n < length < 7 * n),
        )

    def features(self, words: np.ndarray) -> np.ndarray:
        """Shares of shapes and of shape pairs by bucket, and of words that repeat the one before; the last is 1.

        Shares of short texts shrink, as little text says little.
        """
        out = np.zeros(BUCKETS + 2)
        n = len(words)
        if n:
            single = self.bucket[words]
            pair = single[1:] * 31 + single[:-1]
            out[:BUCKETS] = np.bincount(np.concatenate([single, pair]) % BUCKETS, minlength=BUCKETS)
            out[BUCKETS] = 4 * (words[1:] == words[:-1]).sum()
        out = np.sqrt(out / (n + 20))
        out[-1] = 1
        return out


_shapes = TextShapes()


def own_shapes() -> TextShapes:
    """That of this worker process, with its memo. A task's function that named it directly would carry a copy of its own."""
    return _shapes


def pattern_number(votes: tuple[int, ...]) -> int:
    number = 0
    for vote in votes:
        number = number * 3 + vote
    return number


def pattern_votes(number: np.ndarray) -> np.ndarray:
    return (number[:, None] // 3 ** np.arange(len(LABELLERS))[::-1][None, :]) % 3


@dataclass
class WeakLabels:
    """Share of good texts, and the share of GOOD among the votes of each labeller on junk (0) and good (1) texts.

    Silence says nothing: only votes that are cast count.
    """

    good: float
    says_good: np.ndarray  # labeller, class

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability to be good, per row of votes."""
        for_good = np.log(self.says_good[:, 1] / self.says_good[:, 0])
        for_junk = np.log((1 - self.says_good[:, 1]) / (1 - self.says_good[:, 0]))
        log = np.log(self.good / (1 - self.good)) + (votes == GOOD) @ for_good + (votes == JUNK) @ for_junk
        return 1 / (1 + np.exp(-np.clip(log, -500, 500)))

    @property
    def accuracy(self) -> dict[str, float]:
        """Of the votes a labeller casts, the share that is expected to be right."""
        right = (1 - self.good) * (1 - self.says_good[:, 0]) + self.good * self.says_good[:, 1]
        return dict(zip(LABELLERS, right.tolist(), strict=True))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> WeakLabels:
    """Expectation-maximisation; counts are smoothed by one vote of each kind.

    Kinds of junk exclude each other, so on junk all labellers but one or two vote good. Left alone, the estimate
    would then call the odd labeller wrong. The labellers are built to be precise, and that is kept as a bound:
    at most ``FALSE_ALARM`` of their votes on good texts are junk, at least ``MISSED_KIND`` of those on junk.
    """
    votes = pattern_votes(patterns)
    good = np.array([0.95, 0.3, 0.05])[np.minimum((votes == JUNK).sum(axis=1), 2)]
    model = WeakLabels(0.5, np.full((len(LABELLERS), 2), 0.5))
    for _ in range(rounds):
        weights = np.stack([counts * (1 - good), counts * good])
        yes, no = weights @ (votes == GOOD), weights @ (votes == JUNK)
        share = float((weights[1].sum() + 1) / (counts.sum() + 2))
        says_good = ((yes + 1) / (yes + no + 2)).T
        says_good[:, 1] = np.maximum(says_good[:, 1], 1 - FALSE_ALARM)
        says_good[:, 0] = np.minimum(says_good[:, 0], 1 - MISSED_KIND)
        model = WeakLabels(share, says_good)
        now = model.posterior(votes)
        if np.abs(now - good).max() < 1e-9:
            break
        good = now
    return model


@dataclass
class QualityModel:
    labels: WeakLabels
    weights: np.ndarray

    def scores(self, texts: list[str | None]) -> list[float]:
        features = [_shapes.features(w) @ self.weights for w in _shapes.words(texts)]
        return (1 / (1 + np.exp(-np.clip(np.array(features), -60, 60)))).tolist() if features else []


def fit_linear(features: np.ndarray, target: np.ndarray, ridge: float = 0.1, rounds: int = 25) -> np.ndarray:
    """Logistic weights for probabilistic targets by Newton steps; the bias is hardly shrunk."""
    shrink = np.full(features.shape[1], ridge)
    shrink[-1] = 1e-3
    w = np.zeros(features.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        curve = (features * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ features + np.diag(shrink)
        step = np.linalg.solve(curve, features.T @ (target - p) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(docs: DataFrame, text: str = "text", *, sample_rows: int = 6_000, slice_rows: int = 500) -> QualityModel:
    """Estimate the labellers on all rows and fit the scorer on about ``sample_rows`` of them, chosen by a hash."""
    target = pa_schema("pattern bigint, n bigint")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        shapes = own_shapes()
        for batch in batches:
            values = batch.column("text").to_pylist()
            for at in range(0, len(values), slice_rows):
                found.update(pattern_number(shapes.votes(w)) for w in shapes.words(values[at : at + slice_rows]))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], schema=target)

    texts = docs.select(F.col(text).alias("text"))
    counted = texts.mapInArrow(tally, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))
    rows = counted.orderBy("pattern").collect()  # at most 3 ** labellers
    patterns, counts = np.array([r.pattern for r in rows], np.int64), np.array([r.n for r in rows], float)
    if not len(rows):
        return QualityModel(WeakLabels(0.5, np.full((len(LABELLERS), 2), 0.5)), np.zeros(BUCKETS + 2))
    labels = estimate(patterns, counts)

    def sampled(texts: pa.Array) -> dict[str, object]:
        out: dict[str, object] = {"votes": [], "features": []}
        shapes = own_shapes()
        for words in shapes.words(texts.to_pylist()):
            out["votes"].append(pattern_number(shapes.votes(words)))
            out["features"].append(shapes.features(words).astype(np.float32).tobytes())
        return out

    step = max(1, -(-int(counts.sum()) // sample_rows))
    # equal texts are one row, so copies cannot fill the sample
    chosen = texts.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0).distinct()
    kept = written(map_rows(chosen, ["text"], sampled, "votes bigint, features binary"), "quality")
    rows = kept.orderBy("votes", "features").limit(2 * sample_rows).collect()  # bounded; the hash gives about half of it
    if not rows:
        return QualityModel(labels, np.zeros(BUCKETS + 2))
    features = np.stack([np.frombuffer(r.features, np.float32) for r in rows])
    good = labels.posterior(pattern_votes(np.array([r.votes for r in rows], np.int64)))
    return QualityModel(labels, fit_linear(features.astype(float), good))


def score_column(model: QualityModel, text: Column | str, slice_rows: int = 500) -> Column:
    """Probability of each text to be good."""

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        parts = [model.scores(values[at : at + slice_rows]) for at in range(0, len(values), slice_rows)]
        return pa.array([s for part in parts for s in part], pa.float64())

    return scores(text)


def drop_junk(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    return docs.where(score_column(model, text) >= threshold)
