"""The batch job (reference entry points A and B) as Spark jobs.

features -> quality gate -> train both models -> evaluate -> scored profile,
with Parquet only at the durable points (features, models, profile,
evaluation). Every stage is distributed; the driver receives only bounded
results (a tree table, a few statistics, metric rows).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.operators import boosting as G
from vigilo.operators import evaluation as E
from vigilo.operators import periods as FP
from vigilo.operators import presence as A
from vigilo.operators import profile as D
from vigilo.operators import quality as Q
from vigilo.operators import sampling as S
from vigilo.operators import thresholds as TH
from vigilo.operators.iforest import IsolationForest
from vigilo.operators.scaling import fit_standardizer
from vigilo.sources import artifacts as AR
from vigilo.sources.versions import load_or_fit_version
from vigilo.sources.readers import write_features

PRESENCE_FEATURES = ["attendance_rate", "longest_absence_streak", "absence_in_last_30_days", "day_of_week_variance"]


@dataclass
class BatchJobResult:
    presence_features: DataFrame
    period_features: DataFrame
    checks: DataFrame
    gate: DataFrame
    profile: DataFrame
    evaluation: dict


def run_batch_job(spark: SparkSession, presence: DataFrame, periods: DataFrame, dim: DataFrame | None,
                  labels: DataFrame | None, out_dir: str, gbt_iters: int | None = None,
                  n_trees: int = 100, write_history: bool = True, ignore_failed_keys: bool = False) -> BatchJobResult:
    """presence (id, date, is_present), periods (id, term, ...), dim (id, class), labels (id, is_anomaly).

    The checks are evaluated and written before any model is fitted; rows that
    share a key stop the job unless ``ignore_failed_keys``.
    ``write_history`` also stores the presence rows range-partitioned and
    sorted by (id, date), so a one-entity history lookup (D10) reads only the
    row groups whose id range contains it (Parquet min/max skipping).
    """
    # 0. key preconditions of the ordered features (checked, not assumed)
    key_checks = Q.check_unique(presence, ["id", "date"], "presence").unionByName(
        Q.check_unique(periods, ["id", "term"], "periods"))

    # 1. features, written once (the durable hand-off points of the reference)
    att = A.presence_features(presence)
    if labels is not None:
        att = A.attach_labels(att, labels)
    fee = FP.period_features(periods)
    write_features(att, f"{out_dir}/features/presence")
    write_features(fee, f"{out_dir}/features/period")
    att = spark.read.parquet(f"{out_dir}/features/presence")
    fee = spark.read.parquet(f"{out_dir}/features/period")

    # 2. quality gate (one aggregation per table)
    checks = Q.presence_checks(att.withColumnRenamed("id", "student_id")) if labels is not None else None
    fee_checks = Q.period_checks(fee.withColumnRenamed("id", "student_id"))
    checks = fee_checks if checks is None else checks.unionByName(fee_checks)
    checks = checks.unionByName(key_checks)
    checks.write.mode("overwrite").parquet(f"{out_dir}/checks")
    checks = spark.read.parquet(f"{out_dir}/checks")
    gate = Q.quality_gate(checks)
    broken = [r["tbl"] for r in checks.where("check_name = 'unique_key' and not passed").collect()]
    if broken and not ignore_failed_keys:
        raise ValueError(f"rows share a key in: {', '.join(broken)} (see {out_dir}/checks)")

    # 3. anomaly model: standardise -> forest -> contamination offset
    feats = att.fillna(0.0, ["day_of_week_variance"])
    def fit_anomaly():
        scaler = fit_standardizer(feats, PRESENCE_FEATURES)
        forest, _ = IsolationForest(PRESENCE_FEATURES, n_trees=n_trees).fit_score(scaler.transform(feats), keep=[])
        return AR.AnomalyModel(scaler, forest)
    # scaler and forest are one artifact: both are loaded or both are fitted
    anomaly = load_or_fit_version(spark, f"{out_dir}/models/anomaly", AR.load_anomaly, fit_anomaly, AR.save_anomaly,
                                  feats.select("id", *PRESENCE_FEATURES))
    scored_att = anomaly.forest.decision(anomaly.scaler.transform(feats))
    risk = TH.risk_from_decision("decision")
    att_scored = feats.join(scored_att.select("id", risk.alias("risk_raw"), F.col("is_flagged").alias("is_anomaly_pred")), "id")

    # 4. default models: binary (split -> SMOTE on train -> GBT) and 3-class status (weighted)
    extra = {} if gbt_iters is None else {"maxIter": gbt_iters}
    inputs = FP.model_inputs(fee)
    split = S.stratified_split(inputs, "fee_default", 0.2, 42)
    train = split.filter(F.col("split") == "train").select("id", "fee_default", *FP.BINARY_FEATURES)
    balanced = S.smote(train, "fee_default", FP.BINARY_FEATURES, minority=1, k=3, seed=42)
    save = lambda _, model, path: model.save(path)

    def fit_binary():
        model = G.fit_default_binary(balanced, **extra)
        # the decision threshold comes from the training rows, never from the held-out ones
        own = model.predict_proba(split.filter(F.col("split") == "train")).select(
            F.col("fee_default").alias("y_true"), F.col("default_prob").alias("prob"))
        pick = TH.tune_threshold(TH.threshold_scan(own)).first()
        return model.with_threshold(pick["highest"]) if pick and pick["highest"] is not None else model
    binary = load_or_fit_version(spark, f"{out_dir}/models/default_binary", G.DefaultBinaryModel.load, fit_binary, save, train)
    weighted = S.class_weights(fee, "label", "fixed", minority=2, factor=4.0)
    status = load_or_fit_version(spark, f"{out_dir}/models/status_multiclass", G.StatusMulticlassModel.load,
                                 lambda: G.fit_status_multiclass(weighted, weight_col="weight", **extra), save,
                                 weighted.select("id", "label", "weight", *FP.STATUS_FEATURES))

    def written(df, name):  # predictions are read by many tables: score once, read the file
        df.write.mode("overwrite").parquet(f"{out_dir}/predictions/{name}")
        return spark.read.parquet(f"{out_dir}/predictions/{name}")
    fee_pred = written(status.predict(fee).select("id", F.col("p_2").alias("default_prob"), "label_pred",
                                                  "total_outstanding", "days_since_last_payment", "label",
                                                  "previous_term_status"), "status")

    # 5. evaluation tables (held-out binary, in-sample multiclass, anomaly vs labels)
    test = split.filter(F.col("split") == "test")
    bp = written(binary.predict_proba(test).select("id", F.col("fee_default").alias("y_true"),
                                                   (F.col("default_prob") >= binary.threshold).cast("int").alias("y_pred"),
                                                   F.col("default_prob").alias("prob")), "default_held_out")
    mp = fee_pred.select("id", F.col("label").alias("y_true"), F.col("label_pred").alias("y_pred"))
    scan = TH.threshold_scan(bp)
    evaluation = {
        "default_threshold_scan": scan,
        "default_threshold_pick": TH.tune_threshold(scan),
        "default_risk_scores": G.score_default_risk(fee, binary),
        "default_binary_metrics": E.binary_metrics(bp),
        "default_binary_auc": E.roc_auc(bp),
        "default_binary_confusion": E.confusion_matrix(bp),
        "status_report": E.classification_report(mp, names=["On Time", "Late", "Default"]),
        "status_default_gate": E.target_gate(E.class_recall(mp, 2), "fee_default", "recall", 0.70),
        "status_importances": status.importances(spark),
        "binary_importances": binary.importances(spark),
        "top_default": E.top_default(fee_pred),
    }
    if labels is not None:
        ap = written(att_scored.select("id", F.col("is_anomaly").alias("y_true"), "risk_raw", "longest_absence_streak", "attendance_rate",
                                       F.col("is_anomaly_pred").cast("int").alias("y_pred")), "anomaly")
        metrics = E.binary_metrics(ap)
        evaluation["anomaly_metrics"] = metrics
        evaluation["anomaly_gate"] = E.target_gate(metrics, "anomaly", "recall", 0.60)
        evaluation["anomaly_confusion"] = E.confusion_matrix(ap)
        evaluation["anomaly_report"] = E.classification_report(ap, classes=[0, 1], names=["Normal", "Anomaly"])
        evaluation["anomaly_top_flagged"] = (
            ap.where("y_pred = 1").orderBy(F.desc("risk_raw"), "id").limit(10)
            .withColumn("verdict", F.when(F.col("y_true") == 1, "Correctly Flagged").otherwise("False Positive")))
    AR.write_evaluation(evaluation, f"{out_dir}/evaluation")

    # 6. history store for per-entity lookups, then the scored profile (durable table the dashboard reads)
    if write_history:
        (presence.select("id", "date", "is_present").repartitionByRange("id").sortWithinPartitions("id", "date")
         .write.mode("overwrite").parquet(f"{out_dir}/presence_history"))
    prof = D.build_profile(att_scored, fee_pred, dim)
    prof.write.mode("overwrite").parquet(f"{out_dir}/profile")
    profile = spark.read.parquet(f"{out_dir}/profile")
    return BatchJobResult(att, fee, checks, gate, profile, evaluation)
