"""Connected components of a link table, as alternating star rounds.

A round is two aggregations and two joins on 64-bit ids; all state is in tables in the shared folder.
Minima combine on the map side, and Spark splits the joins at nodes that have very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anonkit.llm.common import written


def _to_least(edges: DataFrame) -> DataFrame:
    """For each node u its neighbours v, and the least of u and its neighbours as m."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of a node move to its least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours move to the least of them; links point from greater to lesser."""
    joined = _to_least(edges)
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        joined.select("u", F.col("m").alias("v"))
    )
    return moved.where("u != v").distinct()


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]


def connected_components(links: DataFrame, left: str, right: str, *, most_rounds: int = 100) -> DataFrame:
    """``node`` and its ``root``, the least id it can reach, for every node that has a link to another one.

    Null ends and links of a node to itself are no links. No rows in: no rows out.
    """
    u, v = F.greatest(left, right), F.least(left, right)
    edges = written(
        links.where(F.col(left).isNotNull() & F.col(right).isNotNull())
        .select(u.alias("u"), v.alias("v"))
        .where("u != v")
        .distinct(),
        "links",
    )
    before = _digest(edges)
    if before[0]:
        for _ in range(most_rounds):
            edges = written(_small_star(_large_star(edges)), "links")
            now = _digest(edges)
            if now == before:
                break
            before = now
        else:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
