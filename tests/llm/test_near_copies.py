"""SimHash components against all pairs of fingerprints, with both widths of keys."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from anonkit.llm import simhash
from anonkit.llm.common import table


def parts(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def near_pairs(texts, most=4):
    keys = list(texts)
    prints = np.array([simhash.fingerprint(texts[k]) for k in keys], np.uint64)
    for i, k in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= most):
            yield k, keys[i + 1 + int(j)]


@pytest.mark.parametrize("blocks", [simhash.BLOCKS, (8,) * 8])
def test_documents_equal_all_pairs(spark, blocks):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = parts(texts, near_pairs(texts))
    got = {r.doc_id: r.component_id for r in simhash.simhash_components(docs, "doc_id", "text", blocks=blocks).collect()}
    assert got == want
    kept = {r.doc_id for r in simhash.keep_one_per_group(docs, "doc_id", "text", blocks=blocks).collect()}
    assert kept == set(want.values()) and len(kept) < len(texts)


def test_wide_keys_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40)
    prints = [int(b) for b in base]
    for b in base:
        for bits in range(1, 7):
            prints.append(int(b) ^ sum(1 << int(x) for x in rng.choice(63, bits, replace=False)))
    prints = sorted(set(prints))
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    links = [(r.a, r.b) for r in simhash.near_links(df, 8, blocks=(8,) * 8).collect()]
    pairs = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 4]
    assert parts(prints, links) == parts(prints, pairs)
    assert df.where(F.col("fp").isNull()).count() == 0
