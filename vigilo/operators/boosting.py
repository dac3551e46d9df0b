"""Gradient-boosted default models.

* ``DefaultBinaryModel`` — binary GBT on the 10 derived inputs (M8), MLlib's
  distributed histogram GBT; scoring is a projection.
* ``StatusMulticlassModel`` — 3-class status: one multinomial model (M9). MLlib's
  GBT is binary only, so it is fitted by ``softmax_boosting``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.functions import fee_tier, rint_round
from vigilo.operators.periods import BINARY_FEATURES, STATUS_FEATURES, model_inputs
from vigilo.operators.softmax_boosting import SoftmaxBoosting, fit_softmax_boosting, partitions_for
from vigilo.session import ensure_checkpoint_dir

# Fixed hyper-parameters of the reference (binary script / serving retrain).
BINARY_PARAMS = dict(maxIter=500, stepSize=0.03, maxDepth=3, subsamplingRate=0.7, minInstancesPerNode=2,
                     featureSubsetStrategy="sqrt", seed=42)
MULTICLASS_PARAMS = dict(maxIter=200, stepSize=0.08, maxDepth=4)
BINARY_THRESHOLD = 0.20
CLASSES = (0, 1, 2)


@dataclass
class DefaultBinaryModel:
    model: PipelineModel
    features: list[str]
    threshold: float = BINARY_THRESHOLD

    def predict_proba(self, df: DataFrame, out_col: str = "default_prob") -> DataFrame:
        """Probability of the positive class."""
        cols = df.columns
        out = self.model.transform(df)
        return out.select(*cols, vector_to_array("probability")[1].alias(out_col))

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance, rank), most important first."""
        imp = self.model.stages[-1].featureImportances.toArray().tolist()
        return _importance_frame(spark, self.features, imp)

    def with_threshold(self, threshold: float) -> "DefaultBinaryModel":
        """The same model with a tuned decision threshold."""
        return replace(self, threshold=float(threshold))

    @property
    def iterations(self) -> int:
        return self.model.stages[-1].getNumTrees

    def save(self, path: str) -> None:
        """Pipeline, feature list and threshold."""
        self.model.write().overwrite().save(f"{path}/pipeline")
        _save_params(path, self.features, self.threshold, (0, 1))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "DefaultBinaryModel":
        p = _load_params(spark, path)
        return cls(PipelineModel.load(f"{path}/pipeline"), list(p["features"]), p["threshold"])


def _save_params(path: str, features: list[str], threshold: float, classes: tuple) -> None:
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(list(features), float(threshold), [int(c) for c in classes])],
                          "features array<string>, threshold double, classes array<int>").write.mode("overwrite").parquet(f"{path}/params")


def _load_params(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/params").first()


def _sized(data: DataFrame) -> DataFrame:
    """The cached training rows, materialised and checkpointed, partitions too small to be worth a task joined.

    Every iteration is a few jobs over all of them. The driver keeps a record of every task, and of every job all
    stages of its input's lineage, run or skipped: the checkpoint leaves none of those that made the rows.
    """
    ensure_checkpoint_dir(data.sparkSession)
    return data.coalesce(partitions_for(data.sparkSession, data.count())).checkpoint(eager=True)


def fit_default_binary(train: DataFrame, features: list[str] = BINARY_FEATURES, label: str = "fee_default",
                       weight_col: str | None = None, **params) -> DefaultBinaryModel:
    """M8: binary GBT (reference parameters unless overridden)."""
    p = {**BINARY_PARAMS, **params}
    gbt = GBTClassifier(featuresCol="features", labelCol=label, **p)
    if weight_col:
        gbt.setWeightCol(weight_col)
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    # split finding and the metadata passes read the input again: keep it instead of its lineage
    data = train.select(label, *features, *([weight_col] if weight_col else [])).persist()
    try:
        rows = _sized(data)
    finally:
        data.unpersist()
    return DefaultBinaryModel(Pipeline(stages=[asm, gbt]).fit(rows), list(features))


class StatusMulticlassModel(SoftmaxBoosting):
    """M9: the multinomial status model; probabilities p_0, p_1, p_2 and the threshold rule of M13."""

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance, rank), most important first."""
        return _importance_frame(spark, self.features, self.feature_importances())


def fit_status_multiclass(train: DataFrame, features: list[str] = STATUS_FEATURES, label: str = "label",
                          classes: tuple = CLASSES, weight_col: str | None = None, **params) -> StatusMulticlassModel:
    """M9: one multinomial model of all classes (reference parameters unless overridden)."""
    p = {**MULTICLASS_PARAMS, **params}
    model = fit_softmax_boosting(train, list(features), label, classes, weight_col, rounds=p["maxIter"], rate=p["stepSize"],
                                 depth=p["maxDepth"])
    return StatusMulticlassModel(**vars(model))


def _importance_frame(spark: SparkSession, features: list[str], imp: list[float]) -> DataFrame:
    rows = sorted(zip(features, imp), key=lambda x: (-x[1], x[0]))
    df = spark.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)],
                               "feature string, importance double, rank int")
    return df


def score_default_risk(features: DataFrame, model: DefaultBinaryModel, id_col: str = "id") -> DataFrame:
    """Derived inputs -> probability -> % (1 dp), batch tier (inclusive), will_default."""
    scored = model.predict_proba(model_inputs(features))
    p = F.col("default_prob")
    return scored.select(F.col(id_col).alias("student_id"),
                         rint_round(p * F.lit(100.0), 1).alias("default_probability"),
                         fee_tier(p, inclusive=True).alias("risk_category"),
                         (p >= F.lit(float(model.threshold))).cast("int").alias("will_default"))
