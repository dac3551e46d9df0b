"""M1: standardisation with the population standard deviation.

MLlib's ``StandardScaler`` uses the sample deviation and does not centre by
default, so this is a small estimator of its own: ``fit`` computes every
column's mean and population deviation in ONE aggregation (a bounded
2-numbers-per-column result); ``transform`` is a pure projection with the
fitted values as literals (whole-stage codegen, no join).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class StandardizerModel:
    cols: list[str]
    means: list[float]
    stds: list[float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """(x - mean) / std; a zero deviation divides by 1 (constant column -> 0)."""
        exprs = []
        for c, m, s in zip(self.cols, self.means, self.stds):
            scale = s if s not in (None, 0.0) else 1.0
            exprs.append(((F.col(c).cast("double") - F.lit(m)) / F.lit(scale)).alias(c + suffix))
        keep = [c for c in df.columns if suffix or c not in self.cols]
        return df.select(*keep, *exprs)

    def to_rows(self) -> list[tuple]:
        return list(zip(self.cols, self.means, self.stds))


def fit_standardizer(df: DataFrame, cols: list[str]) -> StandardizerModel:
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return StandardizerModel(list(cols), [row[f"m_{c}"] for c in cols], [row[f"s_{c}"] for c in cols])


def standardize(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """M1 in one call: fit on ``df`` and transform it."""
    return fit_standardizer(df, cols).transform(df, suffix)
