"""Benchmark decontamination by winnowed fingerprints, joined and extended to exact spans.

A k-gram of words is kept as a fingerprint if it has the least hash in one of the windows of consecutive
k-grams that contain it. With k = 5 and 6 k-grams in a window, any 10 equal words in a row have a fingerprint
in common, whatever stands around them. The fingerprints of the texts, each with the words around it, are
joined to those of the benchmark; what is left is extended to the spans of 10 words that hold the fingerprint,
and these are joined to the spans of the benchmark by their words, so no hit rests on a hash. An item of fewer
words is one span and its own fingerprint, for which every run of as many words of a text is looked up.

Both sides are tables and both joins shuffle only fingerprints that pass a bit filter over those of the
benchmark. The filter has a fixed size (``filter_bytes``); a larger benchmark lets more pass, and the join
removes them. Nothing else of the benchmark goes through the driver or is sent to all workers. Texts are never
shuffled. Frequent spans and copies are spread by salts; spans that stand in the same set of items are one
class, so a passage meets its items once, not once a word. Equal texts are matched once, by their digest.

Defined cases: null, empty and wordless texts have no words and no hits; items without words or without
id are left out; items of equal id count once; repeated rows get a row each; an empty benchmark leaves
all texts clean; an empty table gives no rows; other columns have no effect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anonkit.llm.common import own_columns, pa_schema, salted_join, spaced_bytes, written

SPAN = 10
GRAM = 5
WINDOW = SPAN - GRAM + 1  # k-grams
FILTER_BYTES = 8 << 20  # a power of two
BROADCAST_ROWS = 100_000  # digests of 64 characters
SLICE_ROWS = 200
SLICE_CHARS = 1 << 20
BATCH_ROWS = 10_000
_CHUNK = 1 << 18  # bytes whose words are hashed at a time
_BASE = 0x2545F4914F6CDD1D
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                     0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        made.append(np.cumprod(factors, dtype=np.uint64))
    return made[0], made[1]


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word between spaces."""
    parts, at = [], 0
    while at < len(data):
        end = data.find(b" ", at + _CHUNK)
        end = len(data) if end < 0 else end
        part = np.frombuffer(data, np.uint8, end - at, at)
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = part != 32
        edges = np.diff(inside)
        start, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        powers, inverse = _powers(1 << max(len(part) - 1, 1).bit_length())
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[: len(part)], out=total[1:])
        parts.append(((total[stop] - total[start]) * inverse[start], start + at, stop + at))
        at = end
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, start, stop = (np.concatenate(p) for p in zip(*parts, strict=True))
    return hashes, start, stop


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        value = (words[i : len(words) - n + 1 + i] + np.uint64(0x51)) * _FACTORS[i]
        total = (total ^ (value ^ (value >> np.uint64(29)))) * np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions that have the least hash of some full window; all of them where several are equal."""
    count = len(hashes) - window + 1
    if count < 1:
        return np.zeros(0, np.int64)
    least = hashes[:count].copy()
    for i in range(1, window):
        np.minimum(least, hashes[i : count + i], out=least)
    most = np.zeros(len(hashes), np.uint64)
    for i in range(window):
        np.maximum(most[i : count + i], least, out=most[i : count + i])
    return np.flatnonzero(most == hashes)


@dataclass
class Fingerprints:
    """Fingerprints of some texts: their text, hash, the words around them (from, to), and the words of a span."""

    text: np.ndarray
    hash: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray

    def __len__(self) -> int:
        return len(self.text)


class Texts:
    """The words of some texts as hashes in one row; text ``i`` has the words ``first[i]`` to ``first[i + 1]``."""

    def __init__(self, texts: list[str | None]):
        parts = [spaced_bytes(t) for t in texts]
        self.data = b" ".join(parts)
        self.hash, self.start, self.end = hash_words(self.data)
        begin = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        self.first = np.searchsorted(self.start, begin)
        self.count = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(parts)), self.count)

    def words(self, low: int, high: int) -> str:
        return b" ".join(self.data[self.start[low] : self.end[high - 1]].split()).decode("utf-8", "surrogatepass")

    def fingerprints(self, n: int, known: np.ndarray | None = None) -> Fingerprints:
        """Those for spans of ``SPAN`` words, or of ``n`` words where ``n`` is less; with ``known``, those that the filter has."""
        length = GRAM if n >= SPAN else n
        hashes = gram_hashes(self.hash, length)
        place = winnow(hashes) if n >= SPAN else np.arange(len(hashes))
        if known is not None:
            place = place[_passes(known, hashes[place])]
        text = self.owner[place]
        around = SPAN - GRAM if n >= SPAN else 0
        low = np.maximum(place - around, self.first[text])
        high = np.minimum(place + length + around, self.first[text + 1])
        whole = (place + length <= self.first[text + 1]) & (high - low >= n)
        return Fingerprints(text[whole], hashes[place[whole]], low[whole], high[whole], np.full(int(whole.sum()), n))


def _slots(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for shift in (0, 32):
        yield (hashes >> np.uint64(shift)) & np.uint64(bits - 1)


def _passes(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for slot in _slots(hashes, len(known) * 64):
        out &= (known[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return out


def _slices(texts: list[str | None], rows: int) -> Iterator[slice]:
    at = chars = 0
    for i, text in enumerate(texts):
        if i > at and (i - at >= rows or chars + len(text or "") > SLICE_CHARS):
            yield slice(at, i)
            at, chars = i, 0
        chars += len(text or "")
    if at < len(texts):
        yield slice(at, len(texts))


def _batches(target: pa.Schema, columns: dict[str, object], count: int) -> Iterator[pa.RecordBatch]:
    """``count`` rows in batches; a column is an array, a function of a row's number, or missing (null)."""
    for at in range(0, count, BATCH_ROWS):
        end = min(count, at + BATCH_ROWS)
        made = []
        for field in target:
            column = columns.get(field.name)
            if column is None:
                made.append(pa.nulls(end - at, field.type))
            elif callable(column):
                made.append(pa.array([column(i) for i in range(at, end)], field.type))
            else:
                made.append(pa.array(column[at:end], field.type))
        yield pa.RecordBatch.from_arrays(made, schema=target)


def benchmark_table(items: DataFrame, key: str, text: str) -> DataFrame:
    """Written rows of two kinds: a fingerprint (hash, size of its spans), and a span of an item (span, item)."""
    schema = "hash bigint, size bigint, span string, item string"
    target = pa_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for rows in _slices(texts, SLICE_ROWS):
                read, own = Texts(texts[rows]), ids[rows]
                short = set(read.count[(read.count > 0) & (read.count < SPAN)].tolist())
                for n in (SPAN, *short):
                    found = read.fingerprints(n)
                    if n < SPAN:  # only the items that are this one span
                        first = read.first[found.text]
                        kept = (found.low == first) & (read.count[found.text] == n)
                        start, hashes = found.low[kept], found.hash[kept]
                    else:
                        hashes = np.unique(found.hash)
                        start = np.arange(len(read.hash))
                        start = start[start + n <= read.first[read.owner + 1]]
                    yield from _batches(target, {"hash": hashes.view(np.int64), "size": np.full(len(hashes), n)}, len(hashes))
                    spans = {"span": lambda i, s=start, n=n: read.words(s[i], s[i] + n), "item": lambda i, s=start: own[read.owner[s[i]]]}
                    yield from _batches(target, spans, len(start))

    known = items.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    return written(known.mapInArrow(work, schema), "benchmark")


def fingerprint_filter(bench: DataFrame, filter_bytes: int) -> np.ndarray:
    """Two bits for each fingerprint of the benchmark in an array of fixed size."""
    bits = filter_bytes * 8
    slots = F.array(*[F.shiftrightunsigned("hash", s).bitwiseAND(F.lit(bits - 1)) for s in (0, 32)])
    slot = bench.where("hash is not null").select(F.explode(slots).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    rows = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    known = np.zeros(filter_bytes // 8, np.uint64)
    known[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return known


def text_digest(text: str | Column) -> Column:
    return F.sha2(F.col(text) if isinstance(text, str) else text, 256)


def scan_texts(docs: DataFrame, key: str | None, text: str, bench: DataFrame, filter_bytes: int) -> DataFrame:
    """Written rows of two kinds: one per document (key, n_words, and digest if a fingerprint passed the filter), and one
    per such fingerprint (digest, hash, size, number of the first word around it, words around it)."""
    context = docs.sparkSession.sparkContext
    known = context.broadcast(fingerprint_filter(bench, filter_bytes))
    sizes = [r[0] for r in bench.where("hash is not null").select("size").distinct().collect()]  # at most SPAN rows
    kind = docs.schema[key].dataType.simpleString() if key else "boolean"
    schema = f"key {kind}, digest string, n_words bigint, hash bigint, size bigint, low bigint, around string"
    target = pa_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for rows in _slices(texts, SLICE_ROWS):
                read = Texts(texts[rows])
                digest: list[str | None] = [None] * (rows.stop - rows.start)
                for n in sizes:
                    found = read.fingerprints(n, known.value)
                    for i in np.unique(found.text).tolist():
                        if digest[i] is None:
                            digest[i] = hashlib.sha256(texts[rows.start + i].encode("utf-8", "surrogatepass")).hexdigest()
                    columns = {
                        "digest": lambda i, f=found: digest[f.text[i]],
                        "hash": found.hash.view(np.int64),
                        "size": found.size,
                        "low": found.low - read.first[found.text],
                        "around": lambda i, f=found: read.words(f.low[i], f.high[i]),
                    }
                    yield from _batches(target, columns, len(found))
                if key:
                    own = keys.slice(rows.start, len(digest))
                    yield from _batches(target, {"key": own, "digest": np.array(digest, object), "n_words": read.count}, len(digest))

    own = F.col(key) if key else F.lit(None).cast("boolean")
    return written(docs.select(own.alias("key"), F.col(text).alias("text")).mapInArrow(work, schema), "scanned")


def benchmark_spans(bench: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each span with the class of its set of items, and the items of each class."""
    pairs = bench.where("span is not null").select("span", "item").distinct()
    bits = [F.bit_xor(F.xxhash64(F.lit(seed), F.col("item"))).alias(name) for seed, name in ((1, "a"), (2, "b"))]
    kind = F.concat_ws(":", "a", "b", "n").alias("kind")
    spans = pairs.groupBy("span").agg(*bits, F.count("*").alias("n")).select("span", kind)
    one = spans.groupBy("kind").agg(F.min("span").alias("span"))
    return spans, salted_join(pairs, one, ["span"], "inner", ["item"]).select("kind", "item")


def matched_spans(scanned: DataFrame, bench: DataFrame, spans: DataFrame) -> DataFrame:
    """Per text with hits, by its digest: number of the first word of a span that the benchmark has, the span's size and class."""
    prints = scanned.where("hash is not null").select("digest", "hash", "size", "low", "around").distinct()
    known = bench.where("hash is not null").select("hash", "size").distinct()
    joined = salted_join(prints, known, ["hash", "size"], "left_semi", ["digest", "low"])
    words = joined.select("digest", "size", "low", F.split("around", " ").alias("words"))
    places = F.posexplode(F.expr("transform(sequence(0, size(words) - int(size)), i -> array_join(slice(words, i + 1, int(size)), ' '))"))
    extended = words.select("digest", "size", "low", places.alias("i", "span"))
    extended = extended.select("digest", "size", (F.col("low") + F.col("i")).alias("at"), "span")
    return salted_join(extended, spans, ["span"], "inner", ["digest"]).select("digest", "at", "size", "kind")


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, and item_ids."""
    bench = benchmark_table(items, item_key, item_text)
    spans, classes = benchmark_spans(bench)
    scanned = scan_texts(docs, key, text, bench, filter_bytes)
    hits = written(matched_spans(scanned, bench, spans), "hits")
    # words inside any span: what each adds behind the end of those before it
    merged = hits.groupBy("digest", "at").agg(F.max(F.col("at") + F.col("size")).alias("after"))
    before = F.max("after").over(Window.partitionBy("digest").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    gain = F.greatest(F.lit(0), F.col("after") - F.greatest(F.col("at"), F.coalesce(before, F.col("at"))))
    covered = merged.select("digest", gain.alias("gain")).groupBy("digest").agg(F.sum("gain").alias("n_hit"))
    found = salted_join(hits.select("digest", "kind").distinct(), classes, ["kind"], "inner", ["digest"])
    found = found.groupBy("digest").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    results = covered.join(found, "digest")

    rows = scanned.where("n_words is not null").select("key", "digest", "n_words")
    clean = rows.where("digest is null").select("key", "n_words", F.lit(0).cast("bigint").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"))
    other = salted_join(rows.where("digest is not null"), results, ["digest"], "left", ["key", "n_words"])
    other = other.select("key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    return clean.union(other).select(
        F.col("key").alias(key),
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "item_ids",
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    filter_bytes: int = FILTER_BYTES,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The documents without any hit, with all columns. Up to ``broadcast_rows`` digests of texts with hits are counted and sent to
    all tasks, so no text is shuffled; more meet the documents by digest and salt."""
    bench = benchmark_table(items, item_key, item_text)
    scanned = scan_texts(docs, None, text, bench, filter_bytes)
    hits = matched_spans(scanned, bench, benchmark_spans(bench)[0])
    digest = own_columns(docs)("digest")
    found = written(hits.select(F.col("digest").alias(digest)).distinct(), "contaminated")
    marked = docs.withColumn(digest, F.coalesce(text_digest(text), F.lit("")))
    if found.count() <= broadcast_rows:
        kept = marked.join(F.broadcast(found), digest, "left_anti")
    else:
        by = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
        kept = salted_join(marked, found, [digest], "left_anti", by)
    return kept.select(*[F.col(f"`{name}`") for name in docs.columns])


def items_digest(item_ids: list[str]) -> str:
    """Digest of a set of item ids, as the operator reports it."""
    return hashlib.sha256(",".join(sorted(item_ids)).encode()).hexdigest()
