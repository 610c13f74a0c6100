"""Numeric helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int = 2) -> Column:
    """ROUND(x::numeric, n): half away from zero on the decimal value.

    Going through DECIMAL(38,10) first makes the result independent of the
    last-bit noise a different summation order leaves in a double.
    """
    return F.round(_c(c).cast("decimal(38,10)"), digits).cast("double")


def safe_div(num, den) -> Column:
    """x / NULLIF(y, 0) (SF-10); never raises under ANSI mode."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))
