"""k-anonymity: find, count and remove groups of fewer than k people."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anonkit.functions import masks
from anonkit.schema import Policy

# Fixed value: the usual minimum group size.
DEFAULT_K = 5

# Quasi-identifier sets of increasing detail.
LEVELS = {
    "2 quasi-identifiers": ["gender", "country"],
    "3 quasi-identifiers": ["gender", "country", "age_range"],
    "4 quasi-identifiers": ["gender", "country", "age_range", "postal_prefix"],
}


def with_quasi_identifiers(orders: DataFrame, policy: Policy, *more: str) -> DataFrame:
    """Raw orders reduced to the person, the generalized attributes that could single them out, and ``more`` columns."""
    return orders.select(
        "customer_id",
        "gender",
        "country",
        "city",
        masks.age_range(F.col("birth_date"), policy.as_of, policy.age_width).alias("age_range"),
        masks.postal_prefix(F.col("postal_code"), policy.postal_keep).alias("postal_prefix"),
        masks.generalize_postal(F.col("postal_code"), policy.postal_keep).alias("region"),
        *more,
    )


def group_sizes(df: DataFrame, qis: list[str], id_col: str = "customer_id") -> DataFrame:
    """People per group. Exact: Spark first removes repeated (group, person) pairs
    on the map side, then spreads them by group and person, so a group that
    holds a third of all rows is not one task. A NULL attribute forms a group.
    """
    return df.groupBy(*qis).agg(F.countDistinct(id_col).alias("people"))


def k_violations(df: DataFrame, qis: list[str], id_col: str = "customer_id", k: int = DEFAULT_K) -> DataFrame:
    """Groups of fewer than ``k`` people, smallest first."""
    return group_sizes(df, qis, id_col).where(F.col("people") < k).orderBy("people", *qis)


def k_summary(
    df: DataFrame,
    levels: dict[str, list[str]] | None = None,
    id_col: str = "customer_id",
    k: int = DEFAULT_K,
) -> DataFrame:
    """Groups and violating groups for several quasi-identifier sets, in one scan.

    Rows are reduced to distinct (attributes, person) before the sets are
    formed, so the copies that GROUPING SETS makes are copies of people, not of
    orders. A set that has no groups still gives a row.
    """
    levels = LEVELS if levels is None else levels
    columns = list(dict.fromkeys(c for qis in levels.values() for c in qis))
    people = df.select(*columns, id_col).distinct()
    # Sets given twice under two names are formed once.
    sets = list(dict.fromkeys(tuple(c for c in columns if c in qis) for qis in levels.values()))
    sizes = people.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("set_id"), F.countDistinct(id_col).alias("people")
    )

    def set_id(qis: list[str]) -> int:
        # grouping_id has a bit for each column, set where the column is left out
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in qis)

    counts = []
    for i, qis in enumerate(levels.values()):
        member = F.col("set_id") == set_id(qis)
        counts += [F.count_if(member).alias(f"g{i}"), F.count_if(member & (F.col("people") < k)).alias(f"v{i}")]
    stacked = ", ".join(f"'{name}', '{', '.join(qis)}', g{i}, v{i}" for i, (name, qis) in enumerate(levels.items()))
    return sizes.agg(*counts).selectExpr(
        f"stack({len(levels)}, {stacked}) as (level, quasi_identifiers, groups, violating_groups)"
    )


def suppress_small_groups(
    df: DataFrame, qis: list[str], id_col: str = "customer_id", k: int = DEFAULT_K
) -> DataFrame:
    """Rows of groups with at least ``k`` people; the rest are withheld.

    The anti-join is null-safe, or groups with a NULL attribute would slip
    through. Spark broadcasts the small groups only if their measured size
    allows it and otherwise splits hot groups of the row side.
    """
    small = (
        group_sizes(df, qis, id_col)
        .where(F.col("people") < k)
        .select(*[F.col(c).alias(f"_small_{c}") for c in qis])
    )
    same_group: Column = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_small_{c}")) for c in qis])
    return df.join(small, same_group, "left_anti")


def suppress_unique_prefix(
    df: DataFrame,
    postal_code: str = "postal_code",
    output: str = "postal_prefix",
    keep: int = 2,
    replacement: str | None = None,
) -> DataFrame:
    """Add the postal prefix, but not where only one code has it: there it would give the code away."""
    prefix = masks.postal_prefix(F.col(postal_code), keep)
    revealing = (
        df.select(prefix.alias("_prefix"), postal_code)
        .where(F.col(postal_code).isNotNull())
        .groupBy("_prefix")
        .agg(F.countDistinct(postal_code).alias("_codes"))
        .where(F.col("_codes") == 1)
        .select("_prefix", F.lit(True).alias("_reveals"))
    )
    joined = df.withColumn(output, prefix).join(revealing, F.col(output) == F.col("_prefix"), "left")
    shown = F.when(F.col("_reveals"), F.lit(replacement).cast("string")).otherwise(F.col(output))
    return joined.withColumn(output, shown).drop("_prefix", "_reveals")
