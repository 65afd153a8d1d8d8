"""Keyed draws: pseudo-random numbers that depend on a secret and a row key only.

``rand(seed)`` gives a row another value after a repartition or a task retry.
A draw from ``md5(salt || key)`` gives the same value on every executor, in
every re-run and in the stream, so a lost executor cannot change a result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_PER_DRAW = 8
DRAW_RANGE = 16**_HEX_PER_DRAW


def digest(key: Column, salt: str) -> Column:
    return F.md5(F.concat(F.lit(salt), key))


def draw(digest_col: Column, slot: int = 0) -> Column:
    """Integer in [0, 2**32) from one of the four slots of an md5 digest."""
    if not 0 <= slot < 4:
        raise ValueError("an md5 digest holds four draws")
    hex_part = F.substring(digest_col, 1 + _HEX_PER_DRAW * slot, _HEX_PER_DRAW)
    return F.conv(hex_part, 16, 10).cast("bigint")


def unit_interval(draw_col: Column) -> Column:
    """Map a draw into (0, 1], so that its logarithm exists."""
    return (draw_col + 1) / F.lit(float(DRAW_RANGE))


def bernoulli(key: Column, probability: float, salt: str) -> Column:
    """Keyed coin toss: true for about ``probability`` of all keys."""
    return draw(digest(key, salt)) % 1_000_000 < int(round(probability * 1_000_000))
