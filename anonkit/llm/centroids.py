"""Centroid clustering of integer vectors by bit-plane popcounts.

A vector of 64 integer components is held as bit planes: plane b is one 64-bit word with bit b of every
component, in two's complement, so that the last plane weighs ``-2**(planes-1)``. The dot product of a vector and
a centroid is the sum, over all pairs of their planes, of both weights times the number of ones in the AND of the
two words. Distances follow exactly from it: ``|x|^2 - 2 x.c + |c|^2``.

Centroids start as the vectors whose ids hash least. A round is one pass over the packed table: each task assigns
its vectors and adds up bits per cluster, Spark sums over the tasks, and the driver gets one number for each
centroid and component. Nothing but these crosses a task border, so a cluster may hold any share of the rows.

Defined cases: vectors that are null, of another length than 64, or hold null or non-finite components take no
part. Rows without id are assigned like all others, but start no centroid unless ids run out. A repeated row is a
vector each time; equal hashes start in the order of their components. Fewer vectors than centroids: as many
centroids as vectors. Ties go to the smaller centroid number. An empty table gives no rows. Components or
distances that do not fit a long end the job with an error, never with a wrong number. Other columns have no effect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anonkit.llm.common import pa_schema, written

WIDTH = 64
_SAFE_BITS = 62  # below this no sum of 64-bit numbers can overflow


def plane_weights(planes: int) -> list[int]:
    """Worth of a set bit in each plane, in two's complement."""
    return [1 << b for b in range(planes - 1)] + [-(1 << (planes - 1))]


def signed_bits(*values: int) -> int:
    """Planes that hold all of ``values``, the sign among them."""
    return 1 + max((v if v >= 0 else ~v).bit_length() for v in values)


def pack(rows: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of integer rows, as words of shape (rows, planes)."""
    out = np.empty((len(rows), planes), np.uint64)
    for b in range(planes):
        bits = ((rows >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def bits_of(words: np.ndarray) -> np.ndarray:
    """Words of any shape to their 64 bits, along a new last axis."""
    flat = np.ascontiguousarray(words).reshape(-1, 1).view(np.uint8)
    return np.unpackbits(flat, axis=1, bitorder="little").reshape(*words.shape, WIDTH)


def dot_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact dot products of packed rows with packed rows: weighted popcounts of the AND of all plane pairs.

    64-bit sums if the greatest possible one fits, else Python's integers.
    """
    wide = left.shape[1] + right.shape[1] + 6 > _SAFE_BITS
    kind = object if wide else np.int64
    out = np.zeros((len(left), len(right)), kind)
    for a, weight_a in enumerate(plane_weights(left.shape[1])):
        for b, weight_b in enumerate(plane_weights(right.shape[1])):
            ones = np.bitwise_count(left[:, a, None] & right[None, :, b])
            out += ones.astype(kind) * (weight_a * weight_b)
    return out


def squares(packed: np.ndarray) -> np.ndarray:
    """Squared lengths of packed rows."""
    wide = 2 * packed.shape[1] + 6 > _SAFE_BITS
    kind = object if wide else np.int64
    out = np.zeros(len(packed), kind)
    weights = plane_weights(packed.shape[1])
    for a, weight_a in enumerate(weights):
        for b, weight_b in enumerate(weights):
            out += np.bitwise_count(packed[:, a] & packed[:, b]).astype(kind) * (weight_a * weight_b)
    return out


def nearest(packed: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and squared distance to it; ties to the smaller number."""
    distances = squares(packed)[:, None] - 2 * dot_products(packed, centroids) + squares(centroids)[None, :]
    best = distances.argmin(axis=1)
    return best, distances[np.arange(len(packed)), best]


def packed_planes(batch: pa.RecordBatch) -> np.ndarray:
    """The column ``planes`` of a batch as words; every row has as many."""
    column = batch.column("planes")
    words = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return words.reshape(len(column), -1)


def usable(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """Ids and integer components of the vectors that take part."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    kept = vectors.where((F.size(vector) == WIDTH) & finite)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))
    return kept.select(F.col(key).alias("id"), whole.alias("v"))


def pack_table(rows: DataFrame) -> DataFrame:
    """``id`` and bit ``planes`` as a table in the shared folder; as many planes as the greatest component needs."""
    low, high = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if low == -(2**63) or high == 2**63 - 1:  # where Spark's floor stops
        raise OverflowError("a component does not fit a long")
    planes = signed_bits(low, high)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, WIDTH)
            words = pack(values, planes).view(np.int64)
            offsets = np.arange(0, words.size + 1, planes, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(words.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "planes"])

    return written(rows.mapInArrow(run, f"id {kind}, planes array<bigint>"), "planes")


def starting_centroids(rows: DataFrame, count: int, seed: int) -> list[list[int]]:
    """Components of the ``count`` vectors whose ids hash least."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.select(order.alias("at"), "v").orderBy(F.asc_nulls_last("at"), "v").limit(count)
    return [list(row["v"]) for row in first.collect()]


def packed_centroids(centroids: list[list[int]]) -> np.ndarray:
    return pack(np.array(centroids, np.int64), signed_bits(*[c for row in centroids for c in row]))


def moved(packed: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid at the componentwise floor of the mean of its vectors; one without vectors stays."""
    words = packed_centroids(centroids)
    target = pa_schema("cluster int, component int, total string, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            planes = packed_planes(batch)
            best, _ = nearest(planes, words)
            weights, out = plane_weights(planes.shape[1]), []
            for cluster in np.unique(best).tolist():
                own = planes[best == cluster]
                ones = bits_of(own).sum(axis=0, dtype=np.int64)  # how often each bit of each component is set
                totals = [sum(w * int(c) for w, c in zip(weights, column, strict=True)) for column in ones.T]
                out += [(cluster, j, str(total), len(own)) for j, total in enumerate(totals)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    parts = packed.select("planes").mapInArrow(run, "cluster int, component int, total string, n bigint")
    sums = parts.groupBy("cluster", "component").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    after = [list(row) for row in centroids]
    for row in sums.collect():  # one number for each centroid and component
        after[row["cluster"]][row["component"]] = int(row["total"]) // row["n"]
    return after


def assign(packed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``id``, number of the nearest centroid, squared distance."""
    words = packed_centroids(centroids)
    kind = packed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, least = nearest(packed_planes(batch), words)
            if len(least) and int(least.max()) >= 2**63:
                raise OverflowError("a squared distance does not fit a long")
            columns = [batch.column("id"), pa.array(best.astype(np.int32)), pa.array(least.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    return packed.mapInArrow(run, f"id {kind}, cluster int, distance bigint")


def cluster(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = 16,
    rounds: int = 3,
    scale: float = 64.0,
    seed: int = 1,
) -> DataFrame:
    """``key``, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector that takes part."""
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector, scale)
    centroids = starting_centroids(rows, count, seed)
    if not centroids:
        return rows.where("false").select(
            F.col("id").alias(key),
            F.lit(0).alias("cluster"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        )
    packed = pack_table(rows)
    for _ in range(rounds):
        centroids = moved(packed, centroids)
    assigned = written(assign(packed, centroids), "clusters")
    sums = {row[0]: int(row[1]) for row in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    total = sum(sums.values())
    if total >= 2**63:
        raise OverflowError("the inertia does not fit a long")
    names = {c: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for c, row in enumerate(centroids)}
    facts = spark.createDataFrame(  # a row for each centroid
        [(c, sums.get(c, 0), total, name) for c, name in names.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    joined = assigned.join(F.broadcast(facts), "cluster")
    return joined.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(count: int = 16, rounds: int = 3) -> str:
    """The same by all distances, in DuckDB."""
    nearest_of = (
        "SELECT n, vec_id, v, c AS cluster, d AS distance FROM (SELECT k.n, k.vec_id, k.v, m.c, "
        "list_sum(list_transform(range(1, 65), lambda j: (k.v[j] - m.v[j]) * (k.v[j] - m.v[j]))) AS d "
        "FROM kept k CROSS JOIN {centroids} m) QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, c) = 1"
    )
    parts = [
        "usable AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v "
        "FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        "kept AS (SELECT row_number() OVER () AS n, vec_id, v FROM usable)",
        f"m0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept "
        f"WHERE vec_id IS NOT NULL QUALIFY c < {count})",
    ]
    for r in range(rounds):
        parts += [
            f"a{r} AS ({nearest_of.format(centroids=f'm{r}')})",
            f"s{r} AS (SELECT cluster, j, sum(v[j]) AS s, count(*) AS q FROM a{r}, range(1, 65) t(j) GROUP BY ALL)",
            f"m{r + 1} AS (SELECT m.c, coalesce(u.v, m.v) AS v FROM m{r} m LEFT JOIN (SELECT cluster, "
            f"list(CAST((s - ((s % q) + q) % q) // q AS BIGINT) ORDER BY j) AS v FROM s{r} GROUP BY cluster) u ON u.cluster = m.c)",
        ]
    last = nearest_of.format(centroids=f"m{rounds}")
    return (
        f"WITH {', '.join(parts)}, final AS ({last}) SELECT f.vec_id, CAST(f.cluster AS INTEGER) AS cluster, "
        "CAST(f.distance AS BIGINT) AS distance, CAST(sum(f.distance) OVER (PARTITION BY f.cluster) AS BIGINT) AS cluster_inertia, "
        "CAST(sum(f.distance) OVER () AS BIGINT) AS inertia, "
        f"sha256(array_to_string(m.v, ',')) AS centroid_sha256 FROM final f JOIN m{rounds} m ON m.c = f.cluster"
    )
