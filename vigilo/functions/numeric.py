"""Numeric helpers that keep the reference's rounding rules exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rint_round(col: Column | str, digits: int) -> Column:
    """Round half to even at ``digits`` decimals as ``rint(x * 10^k) / 10^k``.

    Spark's ``round`` is half-up and ``bround`` works in decimal, both of which
    disagree with the reference on binary near-ties; the rint form does not.
    """
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def clip(col: Column, lo: float, hi: float) -> Column:
    """Clamp into [lo, hi]."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), col))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, or 0 when den is 0 (zero-division rule of the metrics)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
