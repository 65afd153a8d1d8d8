"""Choose what to publish: the finest column sets that keep k people together, ranges by median cuts, and linkage between views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anonkit.operators.kanon import DEFAULT_K
from anonkit.sources.scratch import as_table

# ---- column sets and levels ----------------------------------------------------


def _name(column: str, level: int) -> str:
    return f"{column}_{level}"


def finest_sets(
    df: DataFrame,
    levels: dict[str, list[Column]],
    id_col: str = "customer_id",
    k: int = DEFAULT_K,
    most_lost: float = 0.0,
) -> DataFrame:
    """The maximal choices of a level for each column under which at most ``most_lost`` of all rows are in groups below ``k``.

    ``levels`` gives for each column its expressions from coarse to fine; each must be a function of the next finer one. Level 0
    leaves the column out. A finer choice splits groups, so it never loses fewer rows: the search goes up level by
    level and tries a choice only if all choices one step coarser have passed. All choices of a level are counted in one job with
    GROUPING SETS over one stored table of distinct people; one row per choice comes back to the driver.

    Columns: one per column with its level, ``levels`` (their sum), ``groups``, ``small_groups``, ``rows_lost``.
    """
    spark, columns = df.sparkSession, list(levels)
    leveled = {_name(c, i + 1): e for c, steps in levels.items() for i, e in enumerate(steps)}
    people = as_table(
        df.select(F.col(id_col).alias("_id"), *[e.alias(n) for n, e in leveled.items()])
        .groupBy("_id", *leveled)
        .agg(F.count("*").alias("_rows")),
        "people",
    )
    total = people.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    names = list(leveled)

    def counted(choices: list[tuple[int, ...]]) -> dict[tuple[int, ...], tuple[int, int, int]]:
        sets = [[_name(c, n) for c, n in zip(columns, choice, strict=True) if n] for choice in choices]
        sizes = people.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in names]).agg(
            F.grouping_id().alias("_set"), F.countDistinct("_id").alias("_people"), F.sum("_rows").alias("_rows")
        )
        small = F.col("_people") < k
        facts = sizes.groupBy("_set").agg(
            F.count("*").alias("groups"),
            F.count_if(small).alias("small"),
            F.coalesce(F.sum(F.when(small, F.col("_rows"))), F.lit(0)).alias("lost"),
        )
        by_set = {r["_set"]: (r["groups"], r["small"], r["lost"]) for r in facts.collect()}
        ids = [sum(1 << (len(names) - 1 - i) for i, n in enumerate(names) if n not in s) for s in sets]
        return {choice: by_set.get(i, (0, 0, 0)) for choice, i in zip(choices, ids, strict=True)}

    def finer(choice: tuple[int, ...]) -> list[tuple[int, ...]]:
        up = [tuple(n + (i == j) for j, n in enumerate(choice)) for i in range(len(columns))]
        return [c for c in up if all(n <= len(levels[col]) for n, col in zip(c, columns, strict=True))]

    def coarser(choice: tuple[int, ...]) -> list[tuple[int, ...]]:
        return [tuple(n - (i == j) for j, n in enumerate(choice)) for i in range(len(columns)) if choice[i]]

    passed: dict[tuple[int, ...], tuple[int, int, int]] = {}
    tried = [tuple([0] * len(columns))]
    while tried:
        facts = counted(tried)
        passed |= {c: f for c, f in facts.items() if f[2] <= most_lost * total}
        tried = sorted({up for c in facts if c in passed for up in finer(c) if all(d in passed for d in coarser(up))})
    best = [(*c, sum(c), *f) for c, f in passed.items() if not any(up in passed for up in finer(c))]
    shown = [*columns, "levels", "groups", "small_groups", "rows_lost"]
    rows = [F.struct(*[F.lit(v).cast("bigint").alias(n) for n, v in zip(shown, row, strict=True)]) for row in best]
    if not rows:
        return spark.range(0).select(*[F.col("id").alias(n) for n in shown])
    return spark.range(1).select(F.inline(F.array(*rows)))


# ---- ranges by median cuts -------------------------------------------------------


def median_groups(people: DataFrame, dimensions: list[str], id_col: str = "customer_id", k: int = DEFAULT_K, most_rounds: int = 200) -> DataFrame:
    """``id_col`` and its ``group``: people cut into groups of at least ``k`` at medians, as finely as that allows.

    ``people`` has one row per person; ``dimensions`` are numbers (codes for names), NULL counts as the least. A round counts people
    per group, dimension and value, finds for each dimension the cut that leaves the most people on the smaller side,
    and cuts each group in the dimension with the widest part of its whole range among those with k people on either
    side. Counts are summed per value before they meet, so a group's task sees its distinct values, not its people.
    Rounds end when no group can be cut. Fewer than ``k`` people in all: one group of them.
    """
    least = people.agg(*[F.min(d).alias(d) for d in dimensions], *[F.max(d).alias(f"_max_{d}") for d in dimensions]).first()
    spans = {d: max(1, (least[f"_max_{d}"] or 0) - (least[d] or 0) + 1) for d in dimensions}
    coded = [F.coalesce(F.col(d).cast("bigint"), F.lit((least[d] or 0) - 1)).alias(f"_d{i}") for i, d in enumerate(dimensions)]
    state = as_table(people.select(id_col, *coded, F.lit("1").alias("group"), F.lit(True).alias("_open")), "groups")
    for _ in range(most_rounds):
        values = F.explode(F.array(*[F.struct(F.lit(i).alias("d"), F.col(f"_d{i}").alias("v")) for i in range(len(dimensions))]))
        counts = state.where("_open").select("group", values.alias("_x")).groupBy("group", "_x.d", "_x.v").agg(F.count("*").alias("n"))
        window = Window.partitionBy("group", "d").orderBy("v")
        placed = counts.select(
            "group",
            "d",
            "v",
            F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("left"),
            F.sum("n").over(Window.partitionBy("group", "d")).alias("all"),
            F.max("v").over(Window.partitionBy("group", "d")).alias("high"),
            F.min("v").over(Window.partitionBy("group", "d")).alias("low"),
        )
        share = reduce(
            lambda e, i: e.when(F.col("d") == i, (F.col("high") - F.col("low") + 1) / spans[dimensions[i]]),
            range(1, len(dimensions)),
            F.when(F.col("d") == 0, (F.col("high") - F.col("low") + 1) / spans[dimensions[0]]),
        )
        smaller = F.least("left", F.col("all") - F.col("left"))
        order = F.struct(share.alias("share"), smaller.alias("smaller"), (-F.col("d")).alias("d"), (-F.col("v")).alias("v"))
        best_cut = placed.where(smaller >= k).groupBy("group", "d").agg(F.max(F.struct(smaller.alias("s"), order.alias("o"))).alias("m"))
        cuts = best_cut.groupBy("group").agg(F.max("m.o").alias("o")).select(
            F.col("group").alias("_group"), (-F.col("o.d")).alias("_d"), (-F.col("o.v")).alias("_v")
        )
        cuts = as_table(cuts, "cuts")
        if cuts.isEmpty():
            break
        value = reduce(lambda e, i: e.when(F.col("_d") == i, F.col(f"_d{i}")), range(1, len(dimensions)), F.when(F.col("_d") == 0, F.col("_d0")))
        side = F.when(value <= F.col("_v"), "0").otherwise("1")
        joined = state.join(cuts, F.col("group") == F.col("_group"), "left")
        state = as_table(
            joined.select(
                id_col,
                *[f"_d{i}" for i in range(len(dimensions))],
                F.when(F.col("_d").isNull(), F.col("group")).otherwise(F.concat("group", side)).alias("group"),
                F.col("_d").isNotNull().alias("_open"),
            ),
            "groups",
        )
    else:
        raise RuntimeError(f"groups could still be cut after {most_rounds} rounds")
    return state.select(id_col, "group")


def median_ranges(people: DataFrame, dimensions: list[str], id_col: str = "customer_id", k: int = DEFAULT_K) -> DataFrame:
    """``id_col``, ``group``, ``people`` in it, and the least and greatest value of each dimension in the group."""
    grouped = people.join(median_groups(people, dimensions, id_col, k), id_col)
    ranges = [f(d).alias(f"{d}_{n}") for d in dimensions for n, f in (("from", F.min), ("to", F.max))]
    facts = grouped.groupBy("group").agg(F.count("*").alias("people"), *ranges)
    return grouped.select(id_col, "group").join(facts, "group")


# ---- linkage between released views ------------------------------------------------


def linkage_audit(rows: DataFrame, shared: dict[str, list[str]], id_col: str = "customer_id") -> DataFrame:
    """How many people fit a released row once several views are put side by side: ``candidates`` and ``view_rows``.

    ``rows`` are the rows of the first view with the person behind each. ``shared`` names, per view, the columns it has in common
    with the first one. A person fits a row if, for each view, a row of theirs agrees in its columns, not necessarily the same
    one. Distinct combinations are counted instead of rows, and the first view named should be the narrowest. Joins are
    on the columns (and person), so Spark splits combinations that very many people share.
    """
    everything = list(dict.fromkeys(c for columns in shared.values() for c in columns))
    combinations = rows.groupBy(*everything).agg(F.count("*").alias("view_rows"))
    combinations = as_table(combinations, "combinations")
    fitting = None
    for columns in shared.values():
        holders = rows.select(*[F.col(c).alias(f"_h_{c}") for c in columns], F.col(id_col).alias("_h_id")).distinct()
        same: Column = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in columns])
        if fitting is None:
            fitting = combinations.join(holders, same).select(*everything, F.col("_h_id").alias("_id"))
        else:
            fitting = fitting.join(holders, same & F.col("_id").eqNullSafe(F.col("_h_id")), "left_semi")
    counted = fitting.groupBy(*everything).agg(F.count("*").alias("candidates"))
    back = counted.select(*[F.col(c).alias(f"_h_{c}") for c in everything], "candidates")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in everything])
    return combinations.join(back, same).groupBy("candidates").agg(F.sum("view_rows").alias("view_rows"))
