"""Rounding and fixed-point arithmetic that do not depend on the order rows are summed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def round_to(value: Column, digits: int) -> Column:
    """Round half up by floor, which every SQL engine computes alike (built-in `round` does not)."""
    scale = 10.0**digits
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def to_micros(value: Column) -> Column:
    """Fixed-point bigint with six decimals: integer sums are exact in any order."""
    return F.floor(value * F.lit(float(MICROS)) + F.lit(0.5))


def from_micros(value: Column) -> Column:
    return value / F.lit(float(MICROS))


def round_sql(value: str, digits: int) -> str:
    """`round_to` for an expression given as text."""
    scale = f"1e{digits}D"
    return f"(floor(({value}) * {scale} + 0.5D) / {scale})"


def micros_sql(value: str) -> str:
    """`to_micros` for an expression given as text."""
    return f"floor(({value}) * 1e6D + 0.5D)"


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation; null instead of an error when either side is constant."""
    varies = (F.max(x) > F.min(x)) & (F.max(y) > F.min(y))
    return F.when(varies, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))
