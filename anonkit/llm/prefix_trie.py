"""Prefix trie of conversations, built in sorted shards around a skeleton of splitter paths.

A conversation is a path: one 16-byte digest for each turn, in turn order. Conversations are dealt into shards by
ranges of (path, id). The splitters between the ranges are rows of a bounded sample, cut to as many turns as tell
them from their predecessor; copies of one conversation are split by their ids. The trie of the splitter paths,
the skeleton, goes to all tasks. All members of a node that is not on it lie in one shard, so a pass over the sorted
shard finishes it. A node on the skeleton may have members in many shards: each shard gives one partial aggregate of
it, and these are reduced by Spark. What skeleton nodes add to the nodes above them is a difference of running sums
over the skeleton in preorder.

Memory: a shard is a stream; open are the path at hand and the finished children of nodes on it. A shard
holds about ``conversations / shards`` rows whichever conversations are copies. The skeleton has at most
one path for each splitter. A conversation's digests (16 bytes a turn) are one row.

The digest of a node's ending ids is SHA-256 over a sorted list, which only a pass in order can give: shards
render their part of a skeleton node's list to pieces, one task per skeleton node hashes the pieces as a stream.

Defined cases: turns without conversation id take no part. Turns are ordered by number, null first, those of one
number by the MD5 of role and text; a repeated row is a turn each time. A null role or text is empty, and so the same as
an empty one. An empty table gives no rows: its root would have no member. Other columns have no effect.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anonkit.llm.common import pa_schema, written

WIDTH = 16  # bytes of a turn's digest
HEAD = 3  # most turns that a rebuilt conversation takes over
SAMPLE_PER_SHARD = 20
PIECE_IDS = 50_000  # ids rendered to one piece of a list
_LEAST_ID = -(2**63)


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` and ``words`` (of each turn) of every conversation, its head taken from the twentieth before."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length keeps ("ab", "c") apart from ("a", "bc")
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    known = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            digest.alias("digest"),
            F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint").alias("words"),
        ).alias("turn"),
    )
    own = known.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % 20
    heads = own.where("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD).alias("head"))
    joined = own.select("conv_id", "turns", base.alias("base"), taken.alias("h")).join(heads, "base", "left")
    head = F.when(F.col("head").isNull() | (F.col("h") == 0), F.slice("turns", 1, 0)).otherwise(
        F.slice("head", F.lit(1), F.col("h"))
    )
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    whole = joined.select("conv_id", F.concat(head, tail).alias("turns"))
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the start."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` borders (path, id), ascending; a row equal to a border is right of it.

    The sample decides how even the shards are, never a result.
    """
    sample = paths.select("path", "conv_id").orderBy(F.xxhash64("conv_id")).limit(shards * SAMPLE_PER_SHARD)
    place = F.row_number().over(Window.orderBy("path", "conv_id"))  # over the bounded sample
    chosen = sample.withColumn("place", place).where((F.col("place") % SAMPLE_PER_SHARD == 0)).orderBy("place").collect()
    out: list[tuple[bytes, int]] = []
    before = b""
    for row in chosen[: shards - 1]:
        path = bytes(row["path"])
        shared = common_turns(before, path)
        if shared * WIDTH == len(path):  # a copy, or a prefix, of the border before: only the id tells them apart
            border = (path, row["conv_id"])
        else:
            border = (path[: (shared + 1) * WIDTH], _LEAST_ID)
        if not out or border > out[-1]:
            out.append(border)
        before = path
    return out


class Skeleton:
    """Trie of the splitter paths; nodes are numbered in preorder, the root is 0."""

    def __init__(self, borders: list[tuple[bytes, int]]):
        self.borders = borders
        self.parent, self.depth, self.children = [-1], [0], [0]
        self.at: dict[tuple[int, bytes], int] = {}
        for path, _ in borders:  # sorted, so that numbers come in preorder
            node = 0
            for start in range(0, len(path), WIDTH):
                step = (node, path[start : start + WIDTH])
                if step not in self.at:
                    self.at[step] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                    self.children.append(0)
                    self.children[node] += 1
                node = self.at[step]
        self.last = list(range(len(self.parent)))  # greatest number in the subtree
        for node in range(len(self.parent) - 1, 0, -1):
            self.last[self.parent[node]] = max(self.last[self.parent[node]], self.last[node])

    def rows(self) -> list[tuple[int, int | None, int, int, int]]:
        return [
            (n, None if n == 0 else self.parent[n], self.depth[n], self.children[n], self.last[n]) for n in range(len(self.parent))
        ]


class _Node:
    __slots__ = ("skeleton", "depth", "words", "least", "members", "children", "leaves", "saved", "hash", "ends", "first_end", "waiting")

    def __init__(self, skeleton: int | None, depth: int, words: int):
        self.skeleton, self.depth, self.words = skeleton, depth, words
        self.least, self.members, self.children, self.leaves, self.saved = 2**63, 0, 0, 0, 0
        self.hash = None if skeleton is not None else hashlib.sha256()
        self.ends: list[int] = []  # of the piece or update at hand
        self.first_end = True
        self.waiting: list[tuple] = []  # finished children that want this node's least id


FINISHED, PARTIAL, PIECE = 0, 1, 2
_FOLDED = (
    "kind int, node bigint, conv_id bigint, depth bigint, parent bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends string"
)


class ShardFold:
    """Nodes of one shard's sorted conversations. ``rows`` gathers what is ready."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.rows: list[tuple] = []
        self.path = b""
        self.stack = [_Node(0, 0, 0)]

    def add(self, path: bytes, conv_id: int, words: list[int]) -> None:
        shared = common_turns(self.path, path)
        while len(self.stack) - 1 > shared:
            self._close()
        for depth in range(shared + 1, len(path) // WIDTH + 1):
            above = self.stack[-1].skeleton
            step = path[(depth - 1) * WIDTH : depth * WIDTH]
            number = None if above is None else self.skeleton.at.get((above, step))
            self.stack.append(_Node(number, depth, words[depth - 1]))
        self.path = path
        top = self.stack[-1]
        top.members += 1
        top.least = min(top.least, conv_id)
        top.ends.append(conv_id)
        if len(top.ends) >= PIECE_IDS:
            self._flush(top)

    def _flush(self, node: _Node) -> None:
        """Ending ids at hand go into the hash, or out as a piece."""
        if not node.ends:
            return
        text = ",".join(map(str, node.ends))
        if node.skeleton is None:
            node.hash.update((text if node.first_end else f",{text}").encode())
        else:
            self.rows.append((PIECE, node.skeleton, node.ends[0], *[None] * 8, text))
        node.first_end = False
        node.ends = []

    def _close(self) -> None:
        node, above = self.stack.pop(), self.stack[-1] if self.stack else None
        self._flush(node)
        for row in node.waiting:
            self.rows.append((*row[:5], node.least, *row[6:]))
        if node.skeleton is None:
            node.leaves += node.children == 0
            node.saved += (node.members - 1) * node.words
            facts = (node.members, node.children, node.leaves, node.saved, node.words, node.hash.hexdigest())
            row = (FINISHED, None, node.least, node.depth, above.skeleton, None, *facts)
            (self.rows if above.skeleton is not None else above.waiting).append(row)
            above.children += 1
        else:
            facts = (node.members, node.children, node.leaves, node.saved, node.words, None)
            self.rows.append((PARTIAL, node.skeleton, node.least, node.depth, None, None, *facts))
        if above is not None:
            above.members += node.members
            above.least = min(above.least, node.least)
            above.leaves += node.leaves
            above.saved += node.saved

    def finish(self) -> None:
        while self.stack:
            self._close()


def folded(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes, partial aggregates of skeleton nodes, and pieces of their lists, shard by shard."""
    shards = len(skeleton.borders) + 1
    shared = paths.sparkSession.sparkContext.broadcast(skeleton)
    dealt_schema = pa_schema("shard int, path binary, conv_id bigint, words array<bigint>")
    target = pa_schema(_FOLDED)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = shared.value.borders
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            shard = pa.array([bisect_right(borders, key) for key in keys], pa.int32())
            rest = [batch.column(name) for name in dealt_schema.names[1:]]
            yield pa.RecordBatch.from_arrays([shard, *rest], schema=dealt_schema)

    def emit(fold: ShardFold) -> pa.RecordBatch:
        columns = list(zip(*fold.rows, strict=True))
        fold.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("shard", "path", "conv_id", "words")]
            for shard, path, conv_id, words in zip(*columns, strict=True):
                if shard != at:
                    if state is not None:
                        state.finish()
                        yield emit(state)
                    at, state = shard, ShardFold(shared.value)
                state.add(path, conv_id, words)
                if len(state.rows) >= 20_000:
                    yield emit(state)
        if state is not None:
            state.finish()
            yield emit(state)

    dealt = paths.select("path", "conv_id", "words").mapInArrow(deal, "shard int, path binary, conv_id bigint, words array<bigint>")
    ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    return written(ordered.mapInArrow(fold, _FOLDED), "trie")


def joined_ends(pieces: DataFrame) -> DataFrame:
    """``node`` and the SHA-256 of its ending ids; the pieces of a node pass one task as a stream, in order."""
    target = pa_schema("node bigint, ends string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, out = None, None, []
        for batch in batches:
            for i in range(batch.num_rows):  # one piece at a time is a Python string
                node, text = batch.column("node")[i].as_py(), batch.column("ends")[i].as_py()
                if node != at:
                    if state is not None:
                        out.append((at, state.hexdigest()))
                    at, state = node, hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
        if state is not None:
            out.append((at, state.hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    ordered = pieces.select("node", "conv_id", "ends").repartition("node").sortWithinPartitions("node", "conv_id")
    return ordered.mapInArrow(run, "node bigint, ends string")


def reduced(parts: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton's nodes, from the partial aggregates of all shards."""
    spark = parts.sparkSession
    trie = spark.createDataFrame(skeleton.rows(), "node bigint, parent bigint, depth bigint, own_children bigint, last bigint")
    partial = parts.where(F.col("kind") == PARTIAL)
    sums = partial.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("words").alias("words"),
    )
    ends = joined_ends(parts.where(F.col("kind") == PIECE))
    whole = trie.join(sums, "node").join(ends, "node", "left")
    whole = whole.withColumn("n_children", F.col("n_children") + F.col("own_children"))
    running = Window.orderBy("node").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # over the skeleton
    own_leaf = (F.col("n_children") == 0).cast("bigint")
    own_saved = (F.col("n_convs") - 1) * F.col("words")
    counted = written(
        whole.withColumns({"own_leaf": own_leaf, "own_saved": own_saved}).withColumns(
            {"leaves_to": F.sum("own_leaf").over(running), "saved_to": F.sum("own_saved").over(running)}
        ),
        "skeleton",
    )
    until = counted.select(
        F.col("node").alias("last"), F.col("leaves_to").alias("leaves_last"), F.col("saved_to").alias("saved_last")
    )
    above = counted.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    leaves = F.col("leaves_last") - F.col("leaves_to") + F.col("own_leaf")  # of skeleton nodes in the subtree
    saved = F.col("saved_last") - F.col("saved_to") + F.col("own_saved")
    return (
        counted.join(until, "last")
        .join(above, "parent", "left")
        .select(
            "node",
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("n_leaves") + leaves).alias("n_leaves"),
            (F.col("saved_tokens") + saved).alias("saved_tokens"),
            F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def trie_nodes(turns: DataFrame, *, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``; conv_id and depth tell nodes apart. ``shards`` is the number of ranges,
    by default that of Spark's shuffle partitions.
    """
    spark = turns.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = written(rebuilt(turns), "paths")
    skeleton = Skeleton(splitters(paths, shards))
    parts = folded(paths, skeleton)
    bones = reduced(parts, skeleton)
    names = bones.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    done = parts.where(F.col("kind") == FINISHED).join(names, "parent", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rest = done.withColumns({"parent_conv_id": F.coalesce("above", "parent_conv_id"), "ends_sha256": F.col("ends")})
    return rest.select(*columns).unionByName(bones.select(*columns))


def oracle_sql() -> str:
    """The same from all prefixes of all conversations, in DuckDB."""
    crc = (
        "xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: "
        "CAST(ascii(s) AS BIGINT))), lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), "
        "lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
    )
    return f"""
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS said FROM conversations WHERE conv_id IS NOT NULL),
    turns AS (
        SELECT conv_id, turn, md5(length(role) || ':' || role || said) AS d,
            len(regexp_extract_all(said, '[^\x20\x09-\x0D]+')) AS w FROM said),
    own AS (SELECT conv_id, list({{'d': d, 'w': w}} ORDER BY turn NULLS FIRST, d) AS p, {crc} % 4 AS h FROM turns GROUP BY conv_id),
    whole AS (
        SELECT o.conv_id, list_concat(coalesce(b.p[1:o.h], []), o.p[o.h + 1:]) AS p
        FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
    members AS (
        SELECT conv_id, d, array_to_string(list_transform(p[1:d], lambda x: x.d), '') AS node, p[d].w AS w, d = len(p) AS ended
        FROM (SELECT conv_id, p, unnest(range(len(p) + 1)) AS d FROM whole)),
    nodes AS (
        SELECT node, d, left(node, 32 * (d - 1)) AS parent, min(conv_id) AS conv_id, count(*) AS n, coalesce(max(w), 0) AS w,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends
        FROM members GROUP BY node, d),
    children AS (SELECT parent, count(*) AS n FROM nodes WHERE d > 0 GROUP BY parent),
    facts AS (
        SELECT t.*, coalesce(c.n, 0) AS n_children, CASE WHEN t.d = 0 THEN 0 ELSE (t.n - 1) * t.w END AS saved
        FROM nodes t LEFT JOIN children c ON c.parent = t.node),
    below AS (
        SELECT left(node, 32 * a) AS node, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum(saved) AS saved
        FROM (SELECT node, n_children, saved, unnest(range(d + 1)) AS a FROM facts) GROUP BY ALL)
    SELECT t.conv_id, CAST(t.d AS BIGINT) AS depth, CASE WHEN t.d > 0 THEN u.conv_id END AS parent_conv_id, t.n AS n_convs,
        t.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, t.ends AS ends_sha256
    FROM facts t JOIN below b ON b.node = t.node LEFT JOIN nodes u ON u.node = t.parent AND u.d = t.d - 1"""
