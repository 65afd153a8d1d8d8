"""Near-duplicates by 64-bit SimHash: all texts that fingerprints within some bits join.

A text's fingerprint has a bit where over half of the hashes of its word shingles have it. Equal fingerprints are one
node. Of some blocks of bits, two fingerprints within the radius share ``len(blocks) - most_different``, so every
such choice of blocks is a key under which they meet. There each row carries its Hamming distances to
reference fingerprints, the pivots. By the triangle inequality a pair whose distances to any pivot differ by
more than the radius is discarded; the rows are sorted by the first pivot, so most pairs are never formed.
Survivors are verified bit by bit. A group gives at most one link per row, to the least row it reaches.

``blocks`` decides how wide the keys are. Six blocks give 15 keys of 20 to 22 bits a fingerprint, which parts some 10^9 distinct
fingerprints well; beyond that pass eight blocks of eight bits (70 keys of 32 bits), which lose no link either.

Defined cases: null, empty and blank texts have fingerprint 0 and are alike; fewer words
than a shingle are one shingle; a null key takes part but names no component unless all are null;
repeated rows are copies of each other; an empty table gives no rows; other columns have no effect.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anonkit.llm.common import own_columns, pa_schema, written
from anonkit.llm.components import connected_components

BITS = 64
MOST_DIFFERENT = 4
BLOCKS = (11, 11, 11, 11, 10, 10)
PIVOTS = 16
GROUP_ROWS = 512
SHINGLE = 4


def _words(text: str | None) -> list[bytes]:
    # bytes.lower folds A-Z only, and bytes.split parts at the six ASCII white space characters only
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(text: str | None, shingle: int, seed: int = 42) -> np.ndarray:
    """Hash of each word shingle of one text, in order; none of a text without words."""
    import xxhash

    words = _words(text)
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    count = max(1, len(words) - shingle + 1)
    stop = ends[-count:].tolist()
    start = [0, *(ends[: count - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(start, stop, strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Unsigned fingerprint of some hashes."""
    count = len(hashes)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 16):  # a very long text in parts
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """Unsigned fingerprint of one text."""
    return majority(shingle_hashes(text, shingle, seed))


def fingerprint_column(text: Column | str, shingle: int, seed: int = 42) -> Column:
    """The fingerprint as a signed bigint."""

    @F.arrow_udf("bigint")
    def prints(texts: pa.Array) -> pa.Array:
        made = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in texts), np.uint64, len(texts))
        return pa.array(made.view(np.int64))

    return prints(text)


def pivots() -> np.ndarray:
    """Reference fingerprints: the first half of SHA-256 of small numbers, so they are alike in every run."""
    import hashlib

    return np.array([int.from_bytes(hashlib.sha256(b"%d" % i).digest()[:8], "big") for i in range(PIVOTS)], np.uint64)


def link_groups(
    group: np.ndarray, salt: np.ndarray, prints: np.ndarray, cross: np.ndarray, most_different: int = MOST_DIFFERENT
) -> np.ndarray:
    """Links within groups of rows that are sorted by group: pairs (row, least row it reaches).

    Where ``cross`` is true, rows of equal salt are compared in another group.
    """
    table = np.bitwise_count(prints[:, None] ^ pivots()[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], group))
    group, salt, prints, cross, table = group[order], salt[order], prints[order], cross[order], table[order]
    first = table[:, 0].astype(np.int16)
    left, right = [], []
    row, step = np.arange(len(group) - 1), 1
    while len(row):
        other = row + step
        near = (group[row] == group[other]) & (first[other] - first[row] <= most_different)
        row, other = row[near], other[near]  # sorted: once a row is past the reach of its pivot distance, it stays so
        keep = ~(cross[row] & (salt[row] == salt[other]))
        a, b = row[keep], other[keep]
        for pivot in range(1, PIVOTS):
            close = np.abs(table[a, pivot] - table[b, pivot]) <= most_different
            a, b = a[close], b[close]
        linked = np.bitwise_count(prints[a] ^ prints[b]) <= most_different
        left.append(a[linked])
        right.append(b[linked])
        step += 1
        row = row[row + step < len(group)]
    if not left:
        return np.zeros((0, 2), np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(group))
    while len(a):  # least reachable row; each pass carries it one link on, and along what it points to
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    rows = np.flatnonzero(label != np.arange(len(group)))
    return np.stack([prints[rows].view(np.int64), prints[label[rows]].view(np.int64)], axis=1)


def _keyed(prints: DataFrame, most_different: int, blocks: tuple[int, ...]) -> DataFrame:
    """One row per fingerprint and choice of shared blocks, with the blocks' bits as ``key``."""
    starts = np.cumsum((0, *blocks))
    keys = []
    for number, chosen in enumerate(combinations(range(len(blocks)), len(blocks) - most_different)):
        key = F.lit(number).cast("bigint")
        for block in chosen:
            bits = F.shiftrightunsigned("fp", int(starts[block])).bitwiseAND(F.lit((1 << blocks[block]) - 1))
            key = F.shiftleft(key, blocks[block]).bitwiseOR(bits)
        keys.append(key)
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def near_links(
    prints: DataFrame, group_rows: int = GROUP_ROWS, most_different: int = MOST_DIFFERENT, blocks: tuple[int, ...] = BLOCKS
) -> DataFrame:
    """Links (``a``, ``b``) that join all distinct fingerprints ``fp`` of at most ``most_different`` different bits.

    Keys of more than ``group_rows`` rows are dealt out by salts; every two salts meet in a task of their own.
    """
    keyed = _keyed(prints, most_different, blocks)
    large = keyed.groupBy("key").count().where(F.col("count") > group_rows)
    salts = F.coalesce(F.ceil(F.col("count") / group_rows), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int")
    salted = keyed.join(large, "key", "left").select("fp", "key", salts.alias("salts")).withColumn("salt", own)
    others = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("with")
    met = salted.select("fp", "key", "salt", others).select(
        "fp", "key", "salt", F.least("salt", "with").alias("lo"), F.greatest("salt", "with").alias("hi")
    )
    target = pa_schema("a bigint, b bigint")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def links(rows: pa.Table) -> pa.RecordBatch:
            key, lo, hi, salt, fp = (rows.column(c).to_numpy() for c in ("key", "lo", "hi", "salt", "fp"))
            turn = np.ones(len(key), bool)
            turn[1:] = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            pairs = link_groups(np.cumsum(turn), salt, fp.view(np.uint64), lo != hi, most_different)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=target)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            key, lo, hi = (rows.column(c).to_numpy() for c in ("key", "lo", "hi"))
            last = np.flatnonzero((key != key[-1]) | (lo != lo[-1]) | (hi != hi[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on in the next batch
            if cut:
                yield links(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None and held.num_rows:
            yield links(held)

    groups = met.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return groups.select("fp", "key", "salt", "lo", "hi").mapInArrow(compare, "a bigint, b bigint")


def components(
    df: DataFrame, key: str, text: str, shingle: int, most_different: int, blocks: tuple[int, ...]
) -> DataFrame:
    """``key``, fingerprint ``fp``, ``body`` (a hash of the whole text), ``root`` and ``component_id`` of every row.

    ``component_id`` is the least key that a row can reach; ``root`` tells components apart whose keys are all null.
    """
    body = F.xxhash64(F.col(text)).alias("body")
    prints = written(df.select(F.col(key).alias("key"), fingerprint_column(text, shingle).alias("fp"), body), "fingerprints")
    links = near_links(prints.select("fp").distinct(), GROUP_ROWS, most_different, blocks)
    nodes = prints.groupBy("fp").agg(F.min("key").alias("least"))
    roots = connected_components(links, "a", "b").withColumnsRenamed({"node": "fp"})
    placed = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    members = placed.join(names, "root").select("fp", "root", "component_id")
    return prints.join(members, "fp").select("key", "fp", "body", "root", "component_id")


def simhash_components(
    df: DataFrame,
    key: str,
    text: str,
    *,
    shingle: int = SHINGLE,
    most_different: int = MOST_DIFFERENT,
    blocks: tuple[int, ...] = BLOCKS,
) -> DataFrame:
    """``key``, fingerprint as 16 hex digits and component of every row."""
    found = components(df, key, text, shingle, most_different, blocks)
    return found.select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_per_group(
    df: DataFrame,
    key: str,
    text: str,
    *,
    shingle: int = SHINGLE,
    most_different: int = MOST_DIFFERENT,
    blocks: tuple[int, ...] = BLOCKS,
) -> DataFrame:
    """``df`` with one row of each component: the one with its least key.

    Rows are found again by key and text hash, natively; of rows that are equal in both, one stays.
    """
    own = own_columns(df)
    body, of, kept_body = own("body"), own("key"), own("kept")
    found = components(df, key, text, shingle, most_different, blocks)
    least = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "body")).alias("least")
    kept = found.groupBy("root").agg(least).select(F.col("least.key").alias(of), F.col("least.body").alias(kept_body))
    same = F.col(key).eqNullSafe(F.col(of)) & (F.col(body) == F.col(kept_body))
    marked = df.withColumn(body, F.xxhash64(F.col(text)))
    return marked.join(kept, same).dropDuplicates([key, body]).select(*df.columns)
