"""Ordinal encoding and the derived model inputs of the default model."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: income bracket codes.
INCOME_CODES = {"High": 0, "Medium": 1, "Low": 2}


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def encode_ordinal(col: Column | str, mapping: dict[str, int] = INCOME_CODES) -> Column:
    """literal map lookup; an unknown value gives NULL (caught by the null check)."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return m[_c(col)]


def default_target(label: Column | str) -> Column:
    """label == 2 -> 1 else 0."""
    return (_c(label) == 2).cast("int")


def is_low_income(income_code: Column | str) -> Column:
    """F8."""
    return (_c(income_code) == 2).cast("int")


def has_many_siblings(siblings: Column | str) -> Column:
    """F9."""
    return (_c(siblings) >= 3).cast("int")


def was_late_or_worse(prev_status: Column | str) -> Column:
    """F10."""
    return (_c(prev_status) >= 1).cast("int")


def days_x_outstanding(days: Column | str, outstanding: Column | str) -> Column:
    """days * outstanding / 10000."""
    return _c(days) * _c(outstanding) / F.lit(10000.0)
