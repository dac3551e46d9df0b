"""Model artifacts and evaluation tables.

Artifacts are written with Spark writers to a (shared) folder: MLlib models
with their own ``MLWriter``; the isolation forest as a Parquet node table
plus a one-row parameter table. Nothing is pickled.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.functions import rint_round, risk_tier
from vigilo.operators.iforest import IsolationForestModel
from vigilo.operators.thresholds import risk_from_decision


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def save_forest(spark: SparkSession, model: IsolationForestModel, path: str) -> None:
    """Node table (Parquet) + parameters (features, psi, offset) as a one-row table."""
    spark.createDataFrame(model.nodes).write.mode("overwrite").parquet(f"{path}/nodes")
    params = [(json.dumps(model.features), int(model.psi), model.offset)]
    spark.createDataFrame(params, "features string, psi int, offset double").write.mode("overwrite").parquet(
        f"{path}/params")


def load_forest(spark: SparkSession, path: str) -> IsolationForestModel:
    """Inverse of :func:`save_forest` (the node table is bounded by the parameters)."""
    p = spark.read.parquet(f"{path}/params").first()
    nodes = spark.read.parquet(f"{path}/nodes").toPandas()
    return IsolationForestModel(json.loads(p["features"]), int(p["psi"]), nodes, p["offset"])


def save_standardizer(spark: SparkSession, model, path: str) -> None:
    spark.createDataFrame(model.to_rows(), "col string, mean double, std double").write.mode("overwrite").parquet(path)


def load_standardizer(spark: SparkSession, path: str):
    from vigilo.operators.scaling import StandardizerModel
    rows = spark.read.parquet(path).collect()
    return StandardizerModel([r["col"] for r in rows], [r["mean"] for r in rows], [r["std"] for r in rows])


@dataclass
class AnomalyModel:
    """Scaler and forest fitted together: one artifact, so they cannot go out of step."""
    scaler: object
    forest: IsolationForestModel

    def flag(self, features: DataFrame, id_col: str = "id") -> DataFrame:
        """New feature rows -> id, risk score (2 dp), flag, tier, with the fitted scaling and offset."""
        clean = features.fillna(0.0, [c for c in self.forest.features if c in features.columns])
        d = self.forest.decision(self.scaler.transform(clean))
        risk = risk_from_decision("decision")
        return d.select(F.col(id_col).alias("student_id"), rint_round(risk, 2).alias("risk_score"), "is_flagged",
                        risk_tier(risk).alias("risk_level"))


def save_anomaly(spark: SparkSession, model: AnomalyModel, path: str) -> None:
    """Both parts below one path; the parameters, written last, make the artifact whole."""
    save_standardizer(spark, model.scaler, f"{path}/scaler")
    save_forest(spark, model.forest, path)


def load_anomaly(spark: SparkSession, path: str) -> AnomalyModel:
    return AnomalyModel(load_standardizer(spark, f"{path}/scaler"), load_forest(spark, path))


def load_or_fit(spark: SparkSession, path: str, load: Callable[[SparkSession, str], object],
                fit: Callable[[], object], save: Callable[[SparkSession, object, str], None]):
    """Load the artifact at ``path``; if absent, incomplete or of another format, fit, save and return it.

    Anything else that goes wrong while reading (permissions, a lost connection)
    is raised: it must not overwrite a good artifact.
    """
    if _exists(spark, path):
        try:
            return load(spark, path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        except (KeyError, TypeError, ValueError):  # parameters of another format
            pass
    model = fit()
    save(spark, model, path)
    return model


def write_evaluation(tables: dict[str, DataFrame], path: str) -> None:
    """Persist each metric table (confusion, report, importances, top-k ...) as Parquet."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
