"""Shared helpers: table reading, intermediate tables in the shared folder, fixed word rules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.session import ensure_checkpoint_dir

#: A word is a run of anything but these ASCII white-space characters (Java regex class body).
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir`` (never a machine-local one on a cluster)."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{label}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Computes the lineage once, cuts it, and survives lost executors: the
    files are shared and a lost reader simply reads them again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however the optimizer moves or inlines the expression.

    Lambda bodies run per element; a plain column reference in them may be
    replaced by its whole definition when a filter is pushed down. A lambda
    variable never is.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of words of a text (null text: no words)."""
    split = F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+", -1)
    return F.filter(split, lambda w: w != "")
