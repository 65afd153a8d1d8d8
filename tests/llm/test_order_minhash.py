import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from anonkit.llm import order_minhash as O


def chained(parts):
    """Spark's xxhash64 of a row of values, unsigned."""
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part, seed)
    return seed


def longs(*values):
    return [v.to_bytes(8, "little") for v in values]


def entries(text):
    words = re.findall(f"[^\x20\x09-\x0d]{{1,{O.WORD_CHARS}}}", text)
    kmers = [chained(w.encode() for w in words[i : i + O.WORDS]) for i in range(len(words))]
    mask = (1 << len(words).bit_length()) - 1 if words else 1
    seen, keys = Counter(), []
    for place, kmer in enumerate(kmers):
        seen[kmer & ~mask] += 1
        key = chained([*longs(kmer), seen[kmer & ~mask].to_bytes(4, "little")])
        keys.append((key & ~mask | place, place))
    # Spark sorts signed numbers; within a bin, whose leading bits are equal, that is the same order
    bins = defaultdict(list)
    for key, place in sorted(keys):
        bins[key >> 58].append(place)
    return {b: chained(longs(*[kmers[p] for p in sorted(places[: O.TUPLE])])) & 0xFFFFFFFF for b, places in bins.items()}


def like(a, b):
    bins = a.keys() | b.keys()
    return sum(a.get(k) == b.get(k) for k in bins) / len(bins) if bins else 1.0


def brute(rows):
    """Rows (id, text), by id and text hash, each with its successor."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(chained([(r[1] or "").encode()]))))
    out = []
    for i, (key, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        own, other, following = entries(text), entries(edited), entries(after)
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(own), shown(other), like(own, other), like(own, following)))
    return sorted(out, key=str)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def shown(found):
    order = sorted(found, key=lambda b: (b < 32, b))  # bins in the order of signed numbers
    return "".join(f"{b:02X}{found[b]:08X}" for b in order)


def run(spark, rows, ranges):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    clash = ("id", "at", "n", "h", "sig", "range", "to", "next", "n_chars", "edited")
    found = O.fingerprints(df.select("*", *[F.lit("x").alias(c) for c in clash]), ranges=ranges)
    return sorted((tuple(r) for r in found.collect()), key=str)


WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "thêta", "日本", "🙂", "a-b", "x,y"]


def made(n, seed):
    rng = random.Random(seed)
    return [(rng.randrange(10**6), " ".join(rng.choices(WORDS, k=rng.randrange(300)))) for _ in range(n)]


@pytest.mark.parametrize("ranges", [1, 7])
def test_equals_brute_force(spark, ranges):
    rows = made(120, 1)
    assert run(spark, rows, ranges) == brute(rows)


@pytest.mark.parametrize("ranges", [1, 5])
def test_odd_rows(spark, ranges):
    rows = [(1, "a plain text"), (1, "a plain text"), (1, "another text of the same id"), (2, None), (3, ""), (4, " \n\t "), (None, "nobody's text")]
    rows += [(None, None), (5, "w" * 5000), (6, "word " * 30_000), (7, "one"), (-(2**63), "least"), (2**63 - 1, "greatest id, last")]
    rows += [(8, "the same row again and again")] * 40
    assert run(spark, rows, ranges) == brute(rows)


def test_few_rows(spark):
    assert run(spark, [], 3) == []
    assert run(spark, [(1, "a b c d e f g h")], 3) == brute([(1, "a b c d e f g h")])
    assert run(spark, [(1, None)], 3) == brute([(1, None)])


def test_order_counts(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    blocks = [words[i : i + 50] for i in range(0, 2000, 50)]
    rng.shuffle(blocks)
    moved = [w for b in blocks for w in b]
    edited = words[:700] + ["new"] + words[701:]
    rows = [(0, " ".join(words)), (1, " ".join(moved)), (2, " ".join(edited))]
    sig = {r["id"]: r["s"] for r in spark.createDataFrame(rows, "id int, t string").select("id", F.array(O.signature(F.col("t"))).alias("s")).collect()}
    pairs = spark.createDataFrame([(sig[0][0], sig[1][0], sig[2][0])], "a array<bigint>, b array<bigint>, c array<bigint>")
    to_moved, to_edited = pairs.select(O.likeness(F.col("a"), F.col("b")), O.likeness(F.col("a"), F.col("c"))).first()
    assert to_edited > 0.9 and to_moved < 0.75  # nearly the same set of words, another order


def test_native_and_computed_once(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id bigint, text string")
    plan = O.fingerprints(df, ranges=2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("regexp_extract_all") == 2  # of the text and of the edited text


def test_query_against_brute_force(spark, sf_dir):
    from anonkit.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op12_order_minhash"](spark, sf_dir).collect()), key=str) == brute(rows)
