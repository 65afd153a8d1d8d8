"""Exact money and percentage expressions.

Sums and averages stay decimal until the last step, so a result does not
depend on the order in which partitions are merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
_WHOLE = "decimal(20,2)"


def total(amount: Column) -> Column:
    return F.sum(amount).cast(_WHOLE)


def mean(amount: Column, scale: int = 2) -> Column:
    """Rounded average. ``avg`` on short decimals runs in double, sum/count does not."""
    return F.round(F.sum(amount) / F.count(amount), scale)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL when ``whole`` is 0."""
    part, whole = part.cast(_WHOLE), whole.cast(_WHOLE)
    return F.round(part * 100 / F.nullif(whole, F.lit(0)), scale)


def percent_raw(part: Column, whole: Column) -> Column:
    """Unrounded percentage as double."""
    return part.cast("double") * 100 / F.nullif(whole.cast("double"), F.lit(0.0))
