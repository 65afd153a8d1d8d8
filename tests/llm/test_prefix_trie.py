import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from anonkit.llm import prefix_trie as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [said for _, said in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    facts = {}
    for node in sorted(members, key=len, reverse=True):
        below = [facts[c] for c in children[node]]
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        leaves = sum(b[0] for b in below) or 1
        facts[node] = (leaves, (len(members[node]) - 1) * words + sum(b[1] for b in below))
    return sorted(
        (
            min(own_ids),
            len(node),
            min(members[node[:-1]]) if node else -(10**30),
            len(own_ids),
            len(children[node]),
            *facts[node],
            hashlib.sha256(",".join(str(c) for c in sorted(own_ids) if len(whole[c]) == len(node)).encode()).hexdigest(),
        )
        for node, own_ids in members.items()
    )


def run(spark, rows, shards):
    df = spark.createDataFrame(rows, SCHEMA)
    clash = ("node", "path", "words", "depth", "turns", "shard", "base", "head", "h", "ends")
    found = P.trie_nodes(df.select("*", *[F.lit("x").alias(c) for c in clash]), shards=shards)
    return sorted(tuple(-(10**30) if v is None else v for v in r) for r in found.collect())


def said(conv, *texts):
    return [(conv, t, ("user", "assistant")[t % 2], text) for t, text in enumerate(texts)]


@pytest.mark.parametrize("shards", [1, 13])
def test_hot_copies_and_long_conversations(spark, shards):
    rows = []
    for c in range(300):
        if c % 3 == 0:  # a third of all are copies of one conversation
            rows += said(c, "same start", "same answer", "and the same end here")
        elif c % 3 == 1:
            rows += said(c, "same start", f"answer {c % 7}", f"end of {c}")
        else:
            rows += said(c, *[f"turn {t} of {c % 50}" for t in range(c % 11)])
    rows += said(1000, *[f"long {t}" for t in range(400)]) + said(1020, *[f"long {t}" for t in range(300)])
    assert run(spark, rows, shards) == brute(rows)


@pytest.mark.parametrize("shards", [1, 5])
def test_odd_rows(spark, shards):
    rows = [
        (None, 0, "user", "nobody's"),
        (0, None, "user", "first, as its number is null"),
        (0, 0, None, "x"),
        (0, 0, "", "x"),  # the same turn, said twice
        (0, 1, "user", None),
        (0, 1, "user", ""),
        (-3, 0, "user", "a b\tc\nd\x0be\x0cf\rg h"),
        (-23, 0, "user", "a"),
        (-20, 0, "user", "a"),
        (7, 0, "ab", "c"),
        (8, 0, "a", "bc"),  # not the same turn
        (9, 2**62, "user", "word " * 50_000),
        (2**63 - 1, 0, "user", "a"),
        (45, 0, "user", "one turn only, and no base"),
        (46, 0, "user", "one turn only, and no base"),
        (47, 0, "user", "one turn only, and no base"),
    ]
    assert run(spark, rows, shards) == brute(rows)


def test_turnless_conversations(spark):
    few = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4]
    rows = [(c, 0, "user", "taken away, as the base is absent") for c in few]
    assert run(spark, rows, 3) == brute(rows)
    assert len(brute(rows)) == 1


def test_no_rows(spark):
    assert run(spark, [], 3) == []
    assert run(spark, [(None, 1, "user", "x")], 3) == []


def test_lists_in_pieces(spark, monkeypatch):
    rows = [row for c in range(0, 500) for row in said(c, "one", "two", "three", "four")]
    fold = P.ShardFold(P.Skeleton([]))
    monkeypatch.setattr(P, "PIECE_IDS", 7)
    path = b"a" * 16
    for c in range(100):
        fold.add(path, c, [3])
    fold.finish()
    finished = [r for r in fold.rows if r[0] == P.FINISHED]
    assert finished[0][-1] == hashlib.sha256(",".join(map(str, range(100))).encode()).hexdigest()
    assert run(spark, rows, 9) == brute(rows)


def test_splitters_tell_copies_apart(spark):
    paths = spark.range(2000).select(
        F.unhex(F.lit("ab" * 16 * 3)).alias("path"), F.col("id").alias("conv_id"), F.array(*[F.lit(1)] * 3).alias("words")
    )
    borders = P.splitters(paths, 16)
    assert len(borders) == 15 and borders == sorted(borders)
    assert len(P.Skeleton(borders).rows()) == 4
