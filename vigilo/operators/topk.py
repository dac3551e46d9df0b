"""Skew-safe "first k rows of every group" (used for latest periods and history).

``row_number() <= k`` is planned by Spark (3.5+) with a *partial*
``WindowGroupLimit`` before the exchange: each map task keeps only its own
first k rows per key, so a key holding a third of the table ships at most
``k * map_tasks`` rows to its reducer. That is the default plan here.

``salt_buckets > 1`` adds an explicit extra stage that first splits each key
into sub-groups by a row hash and keeps k rows per sub-group; use it on
engines without the group-limit rule. Either way the result is exact: the
global first k of a group are among the first k of any sub-group they fall in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                    rank_col: str = "rank", salt_buckets: int = 0) -> DataFrame:
    """Keep the first ``k`` rows of each ``keys`` group under ``order``; adds ``rank_col`` (1-based).

    ``order`` must be a total order within a group (add a unique tie-break
    column) or the chosen rows are not deterministic.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    cols = df.columns
    if salt_buckets and salt_buckets > 1:
        # The salt only spreads a hot key over tasks; any row-to-bucket
        # assignment gives the same final answer.
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salt_buckets))
        w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", salt)
                .withColumn("_r1", F.row_number().over(w1))
                .filter(F.col("_r1") <= k)
                .drop("_r1", "_salt"))
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w2))
              .filter(F.col(rank_col) <= k))
