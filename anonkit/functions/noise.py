"""Multiplicative noise on money columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from anonkit.functions.keyed import digest, draw, unit_interval
from anonkit.functions.money import MONEY

_PPM = 1_000_000
_TWO_PI = 6.283185307179586


def _apply_ppm(value: Column, ppm: Column) -> Column:
    # decimal end to end: the same cents on every executor
    factor = ppm.cast("decimal(8,0)") * F.lit(Decimal("0.000001"))
    return F.round(value * factor, 2).cast(MONEY)


def noise_uniform(value: Column, key: Column, salt: str, ratio: float = 0.05) -> Column:
    """``value`` times a factor drawn evenly from ``1 - ratio`` to ``1 + ratio`` in steps of one millionth.

    The draw depends on the secret and the key only, so the value is the same
    each time the plan is evaluated.
    """
    span = int(round(2 * ratio * _PPM))
    ppm = draw(digest(key, salt)) % (span + 1) + (_PPM - span // 2)
    return _apply_ppm(value, ppm)


def noise_gaussian(value: Column, key: Column, salt: str, sigma: float = 0.025) -> Column:
    """Normal noise with standard deviation ``sigma`` (Box-Muller on two keyed draws)."""
    d = digest(key, salt)
    radius = F.sqrt(F.lit(-2.0) * F.log(unit_interval(draw(d, 0))))
    z = radius * F.cos(F.lit(_TWO_PI) * unit_interval(draw(d, 1)))
    return _apply_ppm(value, F.round(z * (sigma * _PPM)).cast("bigint") + _PPM)


def noise_uniform_random(value: Column, seed: int | None = None, ratio: float = 0.05) -> Column:
    """Uniform noise from ``rand``. Write the result to a table before it is used twice."""
    return F.round(value * (F.lit(1.0 - ratio) + F.rand(seed) * (2 * ratio)), 2).cast(MONEY)


def noise_gaussian_random(value: Column, seed: int | None = None, sigma: float = 0.025) -> Column:
    """Normal noise from ``randn``. Write the result to a table before it is used twice."""
    return F.round(value * (F.lit(1.0) + F.randn(seed) * sigma), 2).cast(MONEY)


def difference_percent(original: Column, noised: Column) -> Column:
    """Change in percent of the original; NULL for an original of 0."""
    return F.round((noised - original) * 100 / F.nullif(original, F.lit(0)), 2)
