"""SimHash components, decontamination and exact search against brute force."""

from __future__ import annotations

import hashlib
import re

import math

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from anonkit.llm import components, decontaminate, simhash, topk
from anonkit.llm.common import table
from anonkit.llm.queries import QUERIES


def lower_ascii(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


# ---- components -------------------------------------------------------------


def brute_components(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return label


def test_components_of_chains_stars_and_odd_links(spark):
    rng = np.random.default_rng(3)
    links = [(i, i + 1) for i in range(-20, 20)] + [(100, i) for i in range(101, 160)]
    links += [tuple(map(int, rng.integers(200, 400, 2))) for _ in range(120)] + [(7, 7), (-5, -4)]
    df = spark.createDataFrame([*links, (None, 3), (900, None)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.connected_components(df, "a", "b").collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == brute_components({x for link in real for x in link}, real)
    assert components.connected_components(df.limit(0), "a", "b").count() == 0


# ---- near-duplicates --------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_components(prints):
    keys = list(prints)
    values = np.array([prints[k] for k in keys], np.uint64)
    links = []
    for i in range(len(keys)):
        links += [(keys[i], keys[i + 1 + j]) for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 4)]
    return brute_components(keys, links)


def test_spark_hashes_are_those_of_the_contract(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_op6_equals_brute_force(spark, sf_dir):
    rows = QUERIES["op6_simhash"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    prints = {k: brute_fingerprint(t) for k, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {k: f"{p:016x}" for k, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == linked_components(prints)


@pytest.mark.parametrize("group_rows", [512, 7])
def test_no_link_is_lost_in_dense_groups(spark, group_rows):
    """Groups of fingerprints few bits apart, chains at the limit, and salted keys."""
    rng = np.random.default_rng(5)
    prints = []
    for _ in range(6):
        base = int(rng.integers(0, 2**63))
        for _ in range(40):
            bits = rng.choice(64, rng.integers(0, 5), replace=False)
            prints.append(base ^ int(sum(1 << int(b) for b in bits)))
    prints += [int(x) for x in rng.integers(0, 2**63, 100)] + [0, 1, 3, 0xFFFF, 2**64 - 1]
    prints = dict(enumerate(dict.fromkeys(prints)))
    df = spark.createDataFrame([(k, p - 2**64 if p >= 2**63 else p) for k, p in prints.items()], "key bigint, fp bigint")
    nodes = {p - 2**64 if p >= 2**63 else p: k for k, p in prints.items()}
    links = [(nodes[r.a], nodes[r.b]) for r in simhash.near_links(df.select("fp"), group_rows).collect()]
    assert brute_components(list(prints), links) == linked_components(prints)
    assert len(links) < 15 * 40 * len(prints)


def test_near_duplicates_of_odd_tables(spark, odd_documents):
    rows = simhash.simhash_components(odd_documents, "doc_id", "text").collect()
    blank = {r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert len(rows) == odd_documents.count() and blank == {2}
    kept = simhash.keep_one_per_group(odd_documents, "doc_id", "text")
    assert kept.columns == odd_documents.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 5, 6, None]
    assert simhash.simhash_components(odd_documents.limit(0), "doc_id", "text").count() == 0


# ---- decontamination --------------------------------------------------------


def brute_contamination(documents, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))

    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = []
    for key, text in documents:
        w = words(text)
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if items_here := windows.get(tuple(w[k : k + n])):
                    found |= items_here
                    hit[k : k + n] = [True] * n
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), sum(hit), len(found), digest, any(hit)))
    return sorted(out, key=str)


def test_op2_equals_brute_force(spark, sf_dir):
    got = sorted(map(tuple, QUERIES["op2_decontaminate"](spark, sf_dir).collect()), key=str)
    documents = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    assert got == brute_contamination(documents, items)
    assert any(r[5] for r in got)


@pytest.mark.parametrize("filter_bytes", [decontaminate.FILTER_BYTES, 8])  # the second lets nearly all pass to the join
def test_short_overlapping_and_frequent_items(spark, odd_documents, filter_bytes):
    long = " ".join(f"w{i % 13}" for i in range(40))
    items = [(1, long), (2, "the The"), (3, "one"), (4, ""), (5, None), (6, "a b c d e f g h i"), (7, "word " * 12), (None, "x"), (2, "the The")]
    documents = [
        (1, long), (2, "x " + long[10:60] + ", y"), (3, "THE the the"), (4, None), (5, "one"), (6, "a b c d e f g h i j"),
        (7, "Word! " * 50), (8, "ONE-the_the"), (9, "é" + long), (9, "é" + long), (None, "one"),
    ]
    df = spark.createDataFrame(documents, "doc_id bigint, text string")
    found = decontaminate.find_contamination(df, spark.createDataFrame(items, "item_id bigint, text string"), filter_bytes=filter_bytes)
    got = sorted((tuple(r)[:6] for r in found.collect()), key=str)
    assert got == brute_contamination(documents, [i for i in dict.fromkeys(items) if i[0] is not None])
    for most in (decontaminate.BROADCAST_ROWS, 0):
        kept = decontaminate.drop_contaminated(
            df, spark.createDataFrame(items, "item_id bigint, text string"), filter_bytes=filter_bytes, broadcast_rows=most
        )
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in got if not r[5])


@pytest.mark.parametrize("letters", ["ab", "abcd"])
def test_matching_few_words_equals_brute_force(spark, letters):
    """Random texts of few words: all overlaps, borders and repetitions, copies, and spans that many items share."""
    rng = np.random.default_rng(len(letters))

    def sequence(most):
        return " ".join(rng.choice(list(letters), rng.integers(0, most)))

    base = sequence(60)
    documents = [(i, sequence(40) if i % 3 else sequence(8) + " " + base[: 2 * int(rng.integers(0, 60))]) for i in range(400)]
    documents += [(1000 + i, documents[7][1]) for i in range(30)]
    for n_items in (1, 12):
        items = [(i, sequence(25) if i % 2 else base[2 * int(rng.integers(0, 20)) :]) for i in range(n_items)]
        df = spark.createDataFrame(documents, "doc_id bigint, text string")
        benchmark = spark.createDataFrame(items, "item_id bigint, text string")
        got = sorted((tuple(r)[:6] for r in decontaminate.find_contamination(df, benchmark).collect()), key=str)
        assert got == brute_contamination(documents, items)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB é-1\n", max_size=30), min_size=1, max_size=4))
def test_words_of_joined_texts(texts):
    read = decontaminate.Texts(texts)
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t)) for t in texts]
    assert read.count.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert [read.words(i, i + 1) for i in range(len(flat))] == flat
    assert len(set(zip(flat, read.hash.tolist(), strict=True))) == len(set(flat)) == len(set(read.hash.tolist()))


def test_word_hashes_do_not_depend_on_the_place(monkeypatch):
    data = b" ".join(b"w%d" % (i % 97) for i in range(5000)) + b" " + b"x" * 3000 + b" w5"
    whole = decontaminate.hash_words(data)
    monkeypatch.setattr(decontaminate, "_CHUNK", 100)
    for a, b in zip(whole, decontaminate.hash_words(data), strict=True):
        assert (a == b).all()
    assert len(set(whole[0].tolist())) == 98 and whole[0][5] == whole[0][-1]


@pytest.mark.parametrize("kind", ["date", "decimal(20,2)", "float", "smallint", "string", "timestamp"])
def test_decontamination_with_keys_of_any_type(spark, kind):
    key = F.lit("2024-01-02" if kind in ("date", "timestamp") else "12").cast(kind)
    words = "one two three four five six seven eight nine ten"
    df = spark.range(2).select(key.alias("doc_id"), F.when(F.col("id") == 0, words).alias("text"))
    found = decontaminate.find_contamination(df, spark.createDataFrame([(1, words)], "item_id bigint, text string"))
    assert dict(found.dtypes)["doc_id"] == kind
    assert sorted(r.n_hit for r in found.where(F.col("doc_id") == key).collect()) == [0, 10]


def test_decontamination_with_a_hot_span_and_a_large_benchmark(spark):
    """A span in a third of the texts and in all items, and more fingerprints than the filter can tell apart."""
    hot = " ".join(f"hot{i}" for i in range(12))
    items = [(i, f"{hot} " + " ".join(f"i{i}x{k}" for k in range(30))) for i in range(60)]
    documents = [(i, (f"d{i} {hot} end" if i % 3 == 0 else f"d{i} " + " ".join(f"i{i % 60}x{k}" for k in range(i % 30)))) for i in range(600)]
    df = spark.createDataFrame(documents, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((tuple(r)[:6] for r in decontaminate.find_contamination(df, benchmark, filter_bytes=64).collect()), key=str)
    assert got == brute_contamination(documents, items)


def test_decontamination_of_odd_tables(spark, odd_documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    rows = decontaminate.find_contamination(odd_documents, none).collect()
    assert len(rows) == 8 and not any(r.contaminated or r.n_hit for r in rows)
    assert {r.items_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert decontaminate.drop_contaminated(odd_documents, none).count() == 8
    assert decontaminate.find_contamination(odd_documents.limit(0), none).count() == 0


# ---- exact search -----------------------------------------------------------


def brute_search(rows, asked, k):
    ids = np.array([r[0] for r in rows])
    values = topk.scaled([r[1] for r in rows], 256.0)
    queries = topk.scaled([r[1] for r in asked] + [[0.0] * values.shape[1]], 256.0)
    out = set()
    for (q, _), vector in zip(asked, queries, strict=False):
        scores = values @ vector
        best = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out |= {(q, rank + 1, int(ids[i]), int(scores[i])) for rank, i in enumerate(best)}
    return out


def test_op9_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    got = {tuple(r) for r in QUERIES["op9_topk"](spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == brute_search(rows, [r for r in rows if r[0] % 50 == 0], 5)


def test_search_in_many_blocks_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 5)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = df.where("vec_id % 10 = 0")
    got = {tuple(r) for r in topk.top_k(df, asked, block_rows=40, query_rows=7).collect()}
    assert got == brute_search(rows, [r for r in rows if r[0] % 10 == 0], 5)


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 2.0], "x"), (50, [1.0, None], "x"), (1, [float("nan"), 1.0], "x"), (2, None, None), (3, [float("inf"), 0.0], "x"),
        (4, [-1.0, 0.5], "x"), (5, [3.0], "x"), (None, [9.0, 9.0], "x"), (6, [], "x"), (7, [1.0, 2.0, 3.0], "x"), (4, [-1.0, 0.5], "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id % 50 = 0")).collect()))
    assert [r[0] for r in got] == [0] * len(got)
    assert [(r[2], r[3]) for r in got] == [(7, 5 * 65536), (5, 3 * 65536), (4, 0), (4, 0), (6, 0)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1e7, 1e9, 1e12])
def test_top_k_of_large_components_is_exact(spark, size):
    rng = np.random.default_rng(int(size))
    rows = [(i, [float(x) for x in rng.choice([0.0, 1.0, -1.0], 6) * (size if i % 2 else 1.0)]) for i in range(40)]
    rows = [(i, v if i % 4 < 2 or size < 1e9 else [x / size for x in v]) for i, v in rows]
    small = [(100 + i, [1.0, -2.0, 3.0, 0.0, 0.5, 1.0]) for i in range(2)]
    df = spark.createDataFrame(rows + small, "vec_id bigint, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id >= 100")).orderBy("query_id", "rank").collect()]
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows + small}
    want = []
    for q, _ in small:
        score = {i: sum(a * b for a, b in zip(whole[q], v)) for i, v in whole.items() if i != q}
        want += [(q, n + 1, i, score[i]) for n, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:5])]
    assert got == want


def test_top_k_says_what_does_not_fit(spark):
    df = spark.createDataFrame([(1, [1e17, 0.0]), (2, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="61 bits"):
        topk.top_k(df, df).collect()
    df = spark.createDataFrame([(1, [1e12] * 3), (2, [1e12] * 3)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(df, df).collect()


def test_top_k_of_one_id_with_two_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [3.0, 1.0]), (3, [1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id = 1"), k=1).collect())
    assert got == [(1, 1, 2, 256 * 768), (1, 1, 3, 256 * 768)]


def test_top_k_moves_single_vectors(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = topk.top_k(df, df.where("vec_id % 10 = 0"), block_rows=40, query_rows=7)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Join" not in plan  # no row grows with a block, no block is copied for a batch
    assert {tuple(r) for r in found.collect()} == brute_search(rows, [r for r in rows if r[0] % 10 == 0], 5)


def test_parts_are_bounded_by_bytes():
    for count, width, itemsize in [(10**9, 64, 2), (10**6, 1024, 8), (10**6, 10**6, 8)]:
        parts = topk.count_parts(count, width, itemsize, 8192, 6)
        assert -(-count // parts) * width * itemsize <= max(topk.PART_BYTES, width * itemsize)
    assert topk.count_parts(300, 5, 2, 40, 6) == 8 and topk.count_parts(0, 1, 2, 40, 6) == 1
    assert topk.count_parts(10**5, 64, 2, 8192, 6) == 12


@pytest.mark.parametrize("size", [1.0, 1e3, 1e8])
def test_search_in_parts_of_vectors_of_many_lengths(spark, size):
    rng = np.random.default_rng(int(size))
    rows = [(i, [float(x) * size for x in rng.integers(-3, 4, rng.integers(0, 9))]) for i in range(400)]
    asked = [(1000 + i, [float(x) for x in rng.integers(-2, 3, rng.integers(0, 7))]) for i in range(30)]
    kind = "vec_id bigint, embedding array<double>"
    got = {tuple(r) for r in topk.top_k(spark.createDataFrame(rows, kind), spark.createDataFrame(asked, kind), block_rows=1, query_rows=4).collect()}
    assert got == brute_search(rows, asked, 5)


@pytest.mark.parametrize("count", [700, 50_000])
def test_blocks_of_any_width_hold_the_best(count):
    rng = np.random.default_rng(count)
    rows = rng.integers(-100, 101, (count, 12)).astype(np.int16)
    queries = rng.integers(-60, 61, (5, 12))
    ids = rng.permutation(count)
    query, row, score = topk.BitSlices(ids, rows).search(np.array([0, 1, 2, count, count + 1]), queries, 5)
    for q, vector in enumerate(queries):
        values = rows.astype(np.int64) @ vector
        best = [i for i in np.lexsort((ids, -values)) if ids[i] != q or q > 2][:5]
        assert row[query == q].tolist() == ids[best].tolist() and score[query == q].tolist() == values[best].tolist()


def test_top_k_of_no_queries_or_no_vectors_scales_nothing(spark):
    df = spark.createDataFrame([(1, [1e17, 0.0]), (2, [1e308])], "vec_id bigint, embedding array<double>")
    assert topk.top_k(df, df.limit(0)).count() == 0 and topk.top_k(df.limit(0), df).count() == 0
    with pytest.raises(Exception, match="61 bits"):
        topk.top_k(df, df).collect()
