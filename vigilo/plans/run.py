"""Run the batch job on presence / period / label files (CSV or Parquet).

    python -m vigilo.plans.run --presence P --periods Q [--labels L] --out DIR [--gbt-iters N] [--trees T]

Inputs use the reference's column names (``student_id`` ...); they are read
with explicit schemas (S1–S3), checked for presence first (S6), and the
features, models, evaluation tables and scored profile are written under
``--out`` (a shared folder on a cluster).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vigilo.plans.batch_job import run_batch_job
from vigilo.sources.readers import read_entity_dim, read_periods, read_presence, require_inputs


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--presence", required=True)
    ap.add_argument("--periods", required=True)
    ap.add_argument("--labels", default=None, help="entity dimension: student_id[, class][, is_anomaly]")
    ap.add_argument("--out", required=True)
    ap.add_argument("--gbt-iters", type=int, default=None, help="override the boosting iterations")
    ap.add_argument("--trees", type=int, default=100)
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName("vigilo-batch").getOrCreate()
    require_inputs(spark, {args.presence: "the presence export", args.periods: "the period export"})
    presence = read_presence(spark, args.presence).withColumnRenamed("student_id", "id")
    periods = read_periods(spark, args.periods).withColumnRenamed("student_id", "id")
    dim = labels = None
    if args.labels:
        d = read_entity_dim(spark, args.labels)
        if d is not None:
            d = d.withColumnRenamed("student_id", "id")
            dim = d.select("id", "class")
            if d.filter(F.col("is_anomaly").isNotNull()).limit(1).count():
                labels = d.select("id", "is_anomaly")
    result = run_batch_job(spark, presence, periods, dim, labels, args.out, gbt_iters=args.gbt_iters,
                           n_trees=args.trees)
    for row in result.gate.collect():
        print(f"quality {row['tbl']}: {'passed' if row['passed'] else 'FAILED'}")
    return result


if __name__ == "__main__":
    main()
