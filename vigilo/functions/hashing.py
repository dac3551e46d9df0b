"""Deterministic per-row randomness (repartition-invariant, unlike rand())."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 52


def hash_bits(*cols: Column | str, seed: int = 42) -> Column:
    """52 uniform bits (bigint) of a seed and a key: the head of an MD5 digest.

    Any key type, no overflow, and any SQL engine with md5 computes the same
    number, so an oracle can reproduce splits and draws.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("bigint")


def unit_hash(*cols: Column | str, seed: int = 42) -> Column:
    """Uniform [0, 1) from :func:`hash_bits`."""
    return hash_bits(*cols, seed=seed).cast("double") / F.lit(float(1 << _BITS))
