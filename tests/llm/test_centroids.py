import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from anonkit.llm import centroids as C


def brute(rows, count=16, rounds=3):
    """Rows (id, components) clustered by all distances."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in order[:count]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle))

    for _ in range(rounds):
        own = [[v for _, v in kept if best(v)[1] == c] for c in range(len(middle))]
        middle = [[sum(col) // len(o) for col in zip(*o)] if o else m for o, m in zip(own, middle)]
    found = [(i, best(v)) for i, v in kept]
    inertia = [sum(d for _, (d, c) in found if c == k) for k in range(len(middle))]
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return [(i, c, d, inertia[c], sum(inertia), names[c]) for i, (d, c) in found]


def key(row):
    return tuple((x is None, x) if x is not None else (True, 0) for x in row)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    clash = ("id", "v", "planes", "cluster", "distance", "inertia", "total")
    return sorted((tuple(r) for r in C.cluster(df.select("*", *[F.lit("x").alias(c) for c in clash]), **options).collect()), key=key)


def vectors(n, seed, size=1.0, shift=0.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=64) * size + shift).tolist()) for i in range(n)]


@pytest.mark.parametrize(("size", "shift"), [(0.2, 0.0), (3.0, -5.0), (1e4, 1e9)])
def test_equals_all_distances(spark, size, shift):
    rows = vectors(150, 3, size, shift)
    assert run(spark, rows) == sorted(brute(rows), key=key)


def test_odd_rows(spark):
    rows = vectors(30, 4) + [(30, None), (31, []), (32, [1.0] * 63), (33, [None] + [0.0] * 63), (34, [float("inf")] * 64)]
    rows += [(35, [float("nan")] * 64), (None, [0.5] * 64), (36, [1.0] * 64), (36, [1.0] * 64), (36, [-1.0] * 64), (37, [0.0] * 64)]
    assert run(spark, rows) == sorted(brute(rows), key=key)


def test_few_equal_and_no_vectors(spark):
    few = vectors(5, 5)
    assert run(spark, few) == sorted(brute(few), key=key)
    same = [(i % 3, [0.25] * 64) for i in range(40)]  # all centroids alike: ties to number 0
    got = run(spark, same)
    assert got == sorted(brute(same), key=key) and {r[1] for r in got} == {0}
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []


def test_what_does_not_fit_is_an_error(spark):
    with pytest.raises(OverflowError):
        run(spark, [(1, [1e300] * 64), (2, [0.0] * 64)])
    with pytest.raises(Exception, match="does not fit a long"):
        run(spark, [(i, [(-1) ** (i + 1) * 1e9 * i] * 64) for i in range(40)])


def test_planes_give_exact_dot_products():
    rng = np.random.default_rng(6)
    for most in (1, 40, 2**20, 2**40, 2**62):
        left, right = (rng.integers(-most, most, (9, 64)) for _ in range(2))
        packed = [C.pack(x, C.signed_bits(int(x.min()), int(x.max()))) for x in (left, right)]
        exact = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in right] for x in left]
        assert C.dot_products(*packed).tolist() == exact
        assert C.squares(packed[0]).tolist() == [sum(int(a) ** 2 for a in x) for x in left]


def test_query_against_brute_force(spark, sf_dir):
    from anonkit.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op13_centroids"](spark, sf_dir).collect())) == sorted(brute(rows))
