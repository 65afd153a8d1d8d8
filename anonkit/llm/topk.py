"""Exact top-k search by inner product over a bit-sliced index.

Vectors are integers (``floor(scale * x)``). The index holds them in blocks of bounded size. In a block the
leading bits of each component are bitmaps over the block's rows: one slice per component and bit. A
query adds the slices, weighted by its components, with carry-save bitmap arithmetic, all slices of a component at once;
a negative weight adds the complement. The sum is a bit-sliced score. Going from its most significant slice
down gives the value that k rows reach; all rows that could pass it given the dropped low bits are the
boundary rows, and their scores are computed exactly. So the result is exact for any number of slices.

The vectors are dealt into parts of bounded size, each to a partition of its own, where they come first and become one
bit-sliced block; the queries come to each part behind them, row by row, and are searched a few hundred at a time. So
a task holds one part and one batch of queries, no row holds more than one vector, and what is shuffled is each
vector once, and each query and its k best once a part. The k best of all parts are ranked once more.

Defined cases: vectors that are null or hold null or non-finite components, and rows without id, take no
part; shorter vectors are filled up with zeros; scores are exact, and a component of more than 61 bits after scaling or
a score beyond a long ends the job with an error, never with a wrong number; rows that have the query's id are its own; a
repeated row is a candidate as often as it occurs, but asked once; rows of one id with different vectors are a query
each, with a ranking each under that id; ties go to the smaller id; an empty table gives no rows; other columns have no effect.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anonkit.llm.common import bound_batches, pa_schema

SLICES = 6
PART_BYTES = 1 << 26
_LIMIT = 2.0**61
_WORDS = 8192


def whole(values: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` of each component."""
    out = np.floor(scale * values)
    if out.size and np.abs(out).max() >= _LIMIT:
        raise OverflowError("a component has more than 61 bits after scaling")
    return out.astype(np.int64)


def scaled(vectors: list[list[float]], scale: float) -> np.ndarray:
    """Integer rows, filled up with zeros to the longest."""
    width = max(1, max(map(len, vectors), default=1))
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return whole(out, scale)


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot product of each row of one array with the same row of the other: in 64 bits if no sum can pass them, else in
    Python's integers."""
    if not len(left):
        return np.zeros(0, np.int64)
    bound = int(np.abs(left).max()) * int(np.abs(right).max()) * left.shape[1]
    if bound < 2**63:
        return (left * right).sum(axis=1)
    sums = (left.astype(object) * right.astype(object)).sum(axis=1)
    if max(map(abs, sums)) >= 2**63:
        raise OverflowError("a score does not fit a long")
    return sums.astype(np.int64)


class BitSlices:
    """Slices of one block: ``slices[tile, component, bit]`` is a bitmap over a tile's rows in 64-bit words.

    A tile is as many words as keep the slices of a few components in the processor's cache.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, count: int = SLICES):
        self.ids, self.rows = ids, rows
        low, high = int(rows.min()), int(rows.max())
        self.bits = count
        self.shift = max(0, (high - low).bit_length() - count)
        words = -(-len(rows) // 64)
        tiles = -(-words // max(1, _WORDS // count))
        size = -(-words // tiles)
        words = tiles * size
        self.slices = np.zeros((tiles, rows.shape[1], count, size), np.uint64)
        flags = np.zeros(words * 64, np.uint8)
        for j in range(rows.shape[1]):
            lead = (rows[:, j].astype(np.int64) - low) >> self.shift
            for bit in range(count):
                flags[: len(rows)] = (lead >> bit) & 1
                self.slices[:, j, bit] = np.packbits(flags, bitorder="little").view(np.uint64).reshape(tiles, size)
        valid = np.zeros(words * 64, np.uint8)
        valid[: len(rows)] = 1
        self.valid = np.packbits(valid, bitorder="little").view(np.uint64)

    def sums(self, queries: np.ndarray) -> np.ndarray:
        """Bit-sliced scores of all rows for each query, up to a constant per query; least significant first."""
        top = int(np.abs(queries).max()).bit_length()
        out = np.zeros((top + self.bits + queries.shape[1].bit_length() + 2, len(queries), len(self.valid)), np.uint64)
        size = self.slices.shape[-1]
        for number, query in enumerate(queries.tolist()):
            for at, tile in enumerate(self.slices):
                self._add_up(tile, query, out[:, number, at * size : (at + 1) * size])
        return out

    def _add_up(self, tile: np.ndarray, query: list[int], out: np.ndarray) -> None:
        """The bit-sliced scores of a tile's rows for one query."""
        stacks: list[list[np.ndarray]] = []  # by weight: slices of components, or of their sums and carries

        def add(waiting: list[list[np.ndarray]], weight: int, bitmap: np.ndarray) -> None:
            while True:
                while len(waiting) <= weight:
                    waiting.append([])
                waiting[weight].append(bitmap)
                if len(waiting[weight]) < 3:
                    return
                x, y, z = waiting[weight]  # full adder
                bitmap = x ^ y
                waiting[weight] = [bitmap ^ z]
                bitmap &= z
                bitmap |= x & y
                weight += 1

        def settle(waiting: list[list[np.ndarray]]) -> None:
            weight = 0
            while weight < len(waiting):
                if len(waiting[weight]) == 2:  # half adder
                    x, y = waiting[weight]
                    waiting[weight] = [x ^ y]
                    add(waiting, weight + 1, x & y)
                weight += 1

        for j, component in enumerate(query):
            if component:
                slices = ~tile[j] if component < 0 else tile[j]
                for b in range(component.bit_length()):
                    if abs(component) >> b & 1:
                        add(stacks, b, slices)
        settle(stacks)
        columns: list[list[np.ndarray]] = []
        for weight, held in enumerate(stacks):
            for stack in held:
                for bit in range(self.bits):
                    add(columns, weight + bit, stack[bit])
        settle(columns)
        for column, held in zip(out, columns):  # columns beyond are empty: no sum has so many bits
            if held:
                column[:] = held[0]

    def candidates(self, queries: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query and row numbers of a set that holds each query's ``k`` best rows."""
        sums = self.sums(queries)
        sure = np.zeros((len(queries), len(self.valid)), np.uint64)
        equal = np.broadcast_to(self.valid, sure.shape).copy()
        reached = [0] * len(queries)
        for column in range(len(sums) - 1, -1, -1):  # the greatest value that k rows reach
            above = equal & sums[column]
            enough = np.bitwise_count(sure | above).sum(axis=1) >= k
            reached = [value * 2 + int(e) for value, e in zip(reached, enough.tolist(), strict=True)]
            sure = np.where(enough[:, None], sure, sure | above)
            equal = np.where(enough[:, None], above, equal & ~sums[column])
        # low bits add between sum(q-)*m and sum(q+)*m for m = 2**shift - 1: all in all |q| * m
        slack = [sum(map(int, row)) * ((1 << self.shift) - 1) for row in np.abs(queries)]
        floor = [max(0, value - (-(-int(s) // (1 << self.shift)))) for value, s in zip(reached, slack, strict=True)]
        greater = np.zeros_like(sure)
        equal = np.broadcast_to(self.valid, sure.shape).copy()
        for column in range(len(sums) - 1, -1, -1):
            one = np.array([(f >> column) & 1 for f in floor], bool)[:, None]
            above = equal & sums[column]
            greater = np.where(one, greater, greater | above)
            equal = np.where(one, above, equal & ~sums[column])
        flags = np.unpackbits((greater | equal).view(np.uint8), axis=1, bitorder="little")
        return np.nonzero(flags[:, : len(self.ids)])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, batch: int | None = None) -> tuple[np.ndarray, ...]:
        """Number of the query, row id and exact score of each query's ``k`` best rows here, without its own.

        ``batch`` queries go down the slices of their scores at once, by default more in a smaller block.
        """
        batch = batch or max(1, min(32, _WORDS // len(self.valid)))
        width = min(queries.shape[1], self.rows.shape[1])
        padded = np.zeros((len(queries), self.rows.shape[1]), np.int64)
        padded[:, :width] = queries[:, :width]
        ids, counts = np.unique(self.ids, return_counts=True)
        at = np.minimum(np.searchsorted(ids, query_ids), len(ids) - 1)
        own = np.where(ids[at] == query_ids, counts[at], 0)
        out = []
        for start in range(0, len(queries), batch):
            part = slice(start, start + batch)
            q, row = self.candidates(padded[part], k + own[part])
            asked = query_ids[part][q]
            other = self.ids[row] != asked
            q, row = q[other], row[other]
            pieces = [slice(i, i + 65536) for i in range(0, len(q), 65536)]
            parts = [exact_products(padded[part][q[i]], self.rows[row[i]].astype(np.int64)) for i in pieces]
            score = np.concatenate([np.zeros(0, np.int64), *parts])
            order = np.lexsort((self.ids[row], -score, q))
            q, row, score = q[order], row[order], score[order]
            first = np.searchsorted(q, q, "left")
            best = np.arange(len(q)) - first < k
            out.append((start + q[best], self.ids[row][best], score[best]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Ids and vectors that take part, as doubles."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    known = F.col(key).isNotNull() & F.col(vector).isNotNull() & finite
    return vectors.where(known).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))


def extent(rows: DataFrame) -> tuple[int, int, float]:
    """Number of rows, the longest vector's length, and the largest size of a component."""
    size = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))
    count, width, most = rows.agg(F.count("*"), F.max(F.size("v")), F.max(size)).first()
    return count, max(1, width or 1), most or 0.0


def pack(rows: DataFrame, columns: list[str], scale: float, kind: np.dtype) -> DataFrame:
    """``columns`` of the rows, and ``packed``: the scaled vector as integers of this kind, one behind the other."""
    schema = ", ".join(f"{c} bigint" for c in columns) + ", packed binary"
    target = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v")
            values = whole(vectors.flatten().to_numpy(zero_copy_only=False), scale)
            short = values.astype(kind)
            if (short != values).any():
                raise OverflowError("a component is larger than all were when they were measured")
            ends = vectors.offsets.to_numpy().astype(np.int64)
            ends = ((ends - ends[0]) * kind.itemsize).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(vectors), [None, pa.py_buffer(ends), pa.py_buffer(short)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), packed], schema=target)

    return rows.select(*columns, "v").mapInArrow(run, schema)


def unpacked(packed: pa.BinaryArray, kind: np.dtype) -> np.ndarray:
    """Integer rows, filled up with zeros to the longest."""
    ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1] // kind.itemsize
    data = packed.buffers()[2]
    values = np.frombuffer(data, kind)[ends[0] : ends[-1]] if data is not None and data.size else np.zeros(0, kind)
    lengths = np.diff(ends)
    width = max(1, int(lengths.max()))
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), kind)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - (ends[:-1] - ends[0])[row]] = values
    return out


def stacked(pieces: list[np.ndarray]) -> np.ndarray:
    """The rows of all pieces, filled up with zeros to the longest; the list is emptied on the way."""
    out = np.zeros((sum(map(len, pieces)), max(p.shape[1] for p in pieces)), pieces[0].dtype)
    end = len(out)
    while pieces:
        piece = pieces.pop()
        out[end - len(piece) : end, : piece.shape[1]] = piece
        end -= len(piece)
    return out


def count_parts(count: int, width: int, itemsize: int, block_rows: int, cores: int) -> int:
    """Parts of the vectors: none over ``PART_BYTES`` on average; some for each core, unless they get smaller than ``block_rows``."""
    largest = max(1, PART_BYTES // (8 + width * (itemsize + 1)))
    return max(1, -(-count // largest), min(-(-count // block_rows), 2 * cores))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: float = 256.0,
    block_rows: int = 8192,
    query_rows: int = 512,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` greatest inner products of each query."""
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = usable(vectors, key, vector)
    asked = usable(queries, key, vector).distinct().withColumn("name", F.xxhash64("id", "v"))
    count, width, most = extent(rows)
    questions, _, asked_most = extent(asked)
    if not (count and questions):  # nothing is scaled then
        rows, asked = rows.where(F.lit(False)), asked.where(F.lit(False))
    bits = math.ceil(min(abs(scale) * max(most, asked_most), _LIMIT)).bit_length() + 1
    kind = np.dtype(np.int16 if bits <= 16 else np.int32 if bits <= 32 else np.int64)
    parts = count_parts(count, width, kind.itemsize, block_rows, spark.sparkContext.defaultParallelism)

    # repeated rows are spread as all others
    part = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    dealt = pack(rows, ["id"], scale, kind).select(
        part.alias("part"), F.lit(False).alias("asks"), "id", F.lit(0).cast("bigint").alias("name"), "packed"
    )
    each = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    asks = pack(asked, ["id", "name"], scale, kind).select(each.alias("part"), F.lit(True).alias("asks"), "id", "name", "packed")
    together = dealt.unionByName(asks).repartitionById(parts, "part").sortWithinPartitions("part", "asks")
    schema = "query_id bigint, asked bigint, vec_id bigint, score bigint"
    target = pa_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, held, index = None, [], [], None
        for batch in batches:
            turns = batch.column("part").to_numpy() * 2 + batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(turns)) + 1).tolist(), len(turns)]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                piece = batch.slice(start, stop - start)
                number, asking = divmod(int(turns[start]), 2)
                if number != at:
                    at, ids, held, index = number, [], [], None
                if not asking:
                    ids.append(piece.column("id").to_numpy().copy())
                    held.append(unpacked(piece.column("packed"), kind).copy())
                    continue
                if held:
                    index = BitSlices(np.concatenate(ids), stacked(held))
                if index is None:  # a part without vectors
                    continue
                for i in range(0, stop - start, query_rows):
                    some = piece.slice(i, query_rows)
                    names, own = some.column("name").to_numpy(), some.column("id").to_numpy()
                    query, row, score = index.search(own, unpacked(some.column("packed"), kind).astype(np.int64), k)
                    columns = (own[query], names[query], row, score)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=target)

    found = together.mapInArrow(search, schema)
    order = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
