"""Token counts against the library, and packing as an exact round trip."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from anonkit.llm import packing, token_counts
from anonkit.llm.common import quiet_tokenizers, table, tokenizer_path

ODD = [
    None, "", " ", "  a", "a  ", "a\n\n b", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>  z", "a" * 5000, "aaa aaaa",
    "it's we're I'LL don't", "日本語 中文", "é́ a\x1cb\x85d", "\t\tx \n y\r\n", "ΑΣ ΟΔΟΣ", "İstanbul ﬁ ½", "👩‍👩‍👧 z",
]


@pytest.fixture(scope="module")
def counter():
    return token_counts.TextCounter(tokenizer_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    quiet_tokenizers()
    from tokenizers import Tokenizer

    return {n: Tokenizer.from_file(tokenizer_path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def by_library(library, name, texts):
    return [e.ids for e in library[name].encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_odd_texts_count_as_in_the_library(counter, library):
    assert counter.counts(ODD) == [len(i) for i in by_library(library, "byte_bpe_50k.json", ODD)]


def test_odd_texts_have_the_library_s_ids(library):
    found = packing.PieceTokenizer(tokenizer_path("word_bpe_49k.json")).encode(ODD)
    assert [f.tolist() for f in found] == by_library(library, "word_bpe_49k.json", ODD)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("ab 'sét\n\t 1.,<|endof text>  ßΣ日\x1c\x85​　́A")), max_size=50))
def test_any_text_counts_as_in_the_library(counter, library, text):
    assert counter.counts([text]) == [len(i) for i in by_library(library, "byte_bpe_50k.json", [text])]


def test_a_full_memo_changes_nothing(library):
    small = token_counts.TextCounter(tokenizer_path("byte_bpe_50k.json"), memo_pieces=3)
    texts = [f"word{i} and more {i}" for i in range(30)]
    assert [c for t in texts for c in small.counts([t])] == [len(i) for i in by_library(library, "byte_bpe_50k.json", texts)]


def test_op10_over_documents(spark, sf_dir, library):
    documents = table(spark, sf_dir, "documents")
    rows = token_counts.count_tokens(documents, "doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    want = dict(zip(texts, map(len, by_library(library, "byte_bpe_50k.json", texts.values())), strict=True))
    assert {r.doc_id: r.n_tokens for r in rows} == want
    assert all(r.over_limit == (r.n_tokens > 512) and r.n_bytes == len((texts[r.doc_id] or "").encode()) for r in rows)


def test_counts_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None, 5), (None, "a b", None), (1, None, 5)], "doc_id bigint, text string, n_tokens int")
    got = sorted(map(tuple, token_counts.count_tokens(df, "doc_id", "text").collect()), key=str)
    assert got == [(1, 0, 0, False), (1, 0, 0, False), (None, 3, 2, False)]
    assert token_counts.count_tokens(df.limit(0), "doc_id", "text").count() == 0


# ---- packing ----------------------------------------------------------------


def check_windows(rows, want, capacity):
    """Every id in one piece, no gaps in documents or sequences, windows full or a power of two."""
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == want.keys()
    for key, ids in want.items():
        at = 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(ids)
    for window in windows.values():
        at = 0
        for r in sorted(window, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_op4_is_an_exact_round_trip(spark, sf_dir, library, capacity):
    documents = table(spark, sf_dir, "documents").repartition(3)
    rows = packing.pack_documents(documents, "doc_id", "text", capacity=capacity).collect()
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    ids = by_library(library, "word_bpe_49k.json", texts.values())
    check_windows(rows, {k: [*i, 1] for k, i in zip(texts, ids, strict=True)}, capacity)


def test_packing_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a " * 9000, "x")], "doc_id bigint, text string, length string")
    rows = packing.pack_documents(df.coalesce(1), "doc_id", "text", with_ids=True).collect()
    check_windows(rows, {1: [1], 2: [1], 3: [*[320] * 9000, 1]}, 2048)
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack_documents(df.limit(0), "doc_id", "text").count() == 0


def test_level_is_the_one_of_least_squares():
    rng = np.random.default_rng(1)
    for _ in range(300):
        levels = packing.SquaredLevels(12)
        levels.count[1:12] = rng.integers(0, 4, 11)
        size = int(rng.integers(1, 12))

        def squares(level):
            count = levels.count.copy()
            if level:
                count[level] -= 1
            count[level + size] += 1
            return int((count[1:12].astype(int) ** 2).sum())

        usable = [h for h in range(0, 12 - size + 1) if h == 0 or levels.count[h]]
        best = levels.best_level(size)
        assert squares(best) == min(map(squares, usable))
        assert best == max(h for h in usable if squares(h) == squares(best))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60))
def test_all_ids_of_any_sizes_are_packed(sizes):
    windows = list(packing.pack(((i, np.arange(n)) for i, n in enumerate(sizes)), 16))
    filled = [sum(len(p.ids) for p in w) for w in windows]
    assert sum(filled) == sum(sizes) and all(f == 16 or f & (f - 1) == 0 for f in filled)
    assert sum(f < 16 for f in filled) <= 4
