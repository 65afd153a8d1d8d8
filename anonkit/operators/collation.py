"""Comparison of text that is blind to case and accents: 'Málaga' and 'malaga' are one group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the collation that compares without case and accents.
BLIND = "UNICODE_CI_AI"


def collated(df: DataFrame, *columns: str, collation: str = BLIND) -> DataFrame:
    """``df`` with ``columns`` under a collation: grouping, joins, distinct and comparisons follow it from here on."""
    return df.withColumns({c: F.collate(F.col(c), collation) for c in columns})


def spelling(column: str) -> Column:
    """One spelling for a group of equal texts: the least one by bytes, as an aggregate."""
    return F.min(F.collate(F.col(column), "UTF8_BINARY"))


def group_spellings(df: DataFrame, column: str, collation: str = BLIND) -> DataFrame:
    """Groups of spellings that are the same text: ``spelling``, ``spellings`` and ``rows`` of each.

    Rows are counted per spelling first, so a hot group meets in one task with as many rows as it has spellings.
    """
    plain = df.groupBy(F.collate(F.col(column), "UTF8_BINARY").alias(column)).agg(F.count("*").alias("rows"))
    grouped = collated(plain.withColumn("_plain", F.col(column)), column, collation=collation).groupBy(column)
    return grouped.agg(
        F.min("_plain").alias("spelling"), F.count("_plain").alias("spellings"), F.sum("rows").alias("rows")
    ).drop(column)
