"""Registered queries of the modelling operators (M1–M16, D11/D12 with real models).

Deterministic steps (standardise, quantile offset, risk, split, weights,
threshold rules, threshold tuning, the exact kNN of oversampling) have SQL
twins. Fitted models (forest, boosted trees, synthetic rows) are checked on
rows and invariants. Boosted trees are fitted with their full iteration budget;
queries that need the same fitted model share its saved artifact (S8, load or
fit) in the shared folder of the application.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from vigilo.functions import rint_round, risk_tier
from vigilo.operators import boosting as G
from vigilo.operators import periods as FP
from vigilo.operators import profile as D
from vigilo.operators import sampling as S
from vigilo.operators import thresholds as TH
from vigilo.operators.iforest import IsolationForest
from vigilo.operators.scaling import fit_standardizer
from vigilo.session import ensure_checkpoint_dir
from vigilo.sources import artifacts as AR
from vigilo.sources.versions import load_or_fit_version
from vigilo.plans.catalog import _t, fee_feats, predictions, presence_feats, r6, register

PRESENCE_FEATURES = ["attendance_rate", "longest_absence_streak", "absence_in_last_30_days", "day_of_week_variance"]
QUERY_TREES = 100


def _artifact(spark, sf, name, load, fit, training):
    """The model that another query fitted on the same training rows, or fit and publish it."""
    tag = hashlib.sha1(f"{spark.sparkContext.applicationId}|{sf}".encode()).hexdigest()[:16]
    path = f"{ensure_checkpoint_dir(spark)}/models-{tag}/{name}"
    return load_or_fit_version(spark, path, load, fit, lambda _, model, p: model.save(p), training)


def _z(spark, sf):
    f = presence_feats(_t(spark, sf)).fillna(0.0, ["day_of_week_variance"])
    return fit_standardizer(f, PRESENCE_FEATURES).transform(f)


@register("m1_standardize")
def m1(spark, sf):
    z = _z(spark, sf)
    return z.select("id", *[r6(c).alias(f"z_{c}") for c in PRESENCE_FEATURES])


def _decision(spark, sf):
    f = presence_feats(_t(spark, sf)).select("id", F.col("attendance_rate").alias("score"))
    off = TH.contamination_offset(f, "score", 0.1)
    return TH.flag_by_contamination(f, off)


@register("m4_contamination_flag")
def m4(spark, sf):
    return _decision(spark, sf).select("id", r6("decision").alias("decision"), "is_flagged")


@register("m5_risk_score")
def m5(spark, sf):
    d = _decision(spark, sf)
    risk = TH.risk_from_decision("decision")
    return d.select("id", rint_round(risk, 6).alias("risk_score"), risk_tier(risk).alias("risk_level"))


@register("m6_stratified_split")
def m6(spark, sf):
    return S.stratified_split(fee_feats(_t(spark, sf)), "label", 0.2, 42).select("id", "label", "split")


@register("m10_class_weights")
def m10(spark, sf):
    f = fee_feats(_t(spark, sf)).select("id", "label")
    fixed = S.class_weights(f, "label", "fixed").withColumnRenamed("weight", "weight_fixed")
    both = S.class_weights(fixed, "label", "balanced")
    return both.select("id", "label", "weight_fixed", r6("weight").alias("weight_balanced"))


def _surrogate_probs(spark, sf):
    s = D.surrogate_fee_scores(fee_feats(_t(spark, sf)))
    p2 = F.col("default_prob")
    p1 = (F.lit(1.0) - p2) * (F.lit(0.35) + F.lit(0.3) * F.col("transport_user"))
    return s.select("id", p2.alias("p_2"), p1.alias("p_1"), (F.lit(1.0) - p2 - p1).alias("p_0"))


@register("m13_threshold_label")
def m13(spark, sf):
    p = _surrogate_probs(spark, sf)
    return p.select("id", r6("p_0").alias("p_0"), r6("p_1").alias("p_1"), r6("p_2").alias("p_2"),
                    TH.threshold_label("p_0", "p_1", "p_2", 0.5).alias("label_pred"))


@register("m14_threshold_scan")
def m14(spark, sf):
    s = TH.threshold_scan(predictions(_t(spark, sf)))
    return s.select("threshold", "tp", "fn", "fp", r6("recall").alias("recall"), r6("precision").alias("precision"))


@register("m14_tune_threshold")
def m14t(spark, sf):
    return TH.tune_threshold(TH.threshold_scan(predictions(_t(spark, sf))))


def _binary_train(spark, sf):
    f = FP.model_inputs(fee_feats(_t(spark, sf)))
    return S.stratified_split(f, "fee_default", 0.2, 42).filter(F.col("split") == "train")


@register("m7_smote_knn")
def m7k(spark, sf):
    tr = _binary_train(spark, sf).filter(F.col("fee_default") == 1)
    nn = S.knn_within(tr, FP.BINARY_FEATURES, k=3)
    return nn.select("id", "nbr_id", "nn", r6("dist").alias("dist"))


# ------------------------------------------------------------ rows-only (fitted models)
def _forest(spark, sf, z):
    return IsolationForest(PRESENCE_FEATURES, n_trees=QUERY_TREES, max_samples=256, contamination=0.1,
                           seed=42).fit(z)


@register("m2_isolation_forest_fit")
def m2(spark, sf):
    z = _z(spark, sf)
    m = _forest(spark, sf, z)
    return spark.createDataFrame(m.nodes)


def _forest_of(z):
    return IsolationForest(PRESENCE_FEATURES, n_trees=QUERY_TREES, max_samples=256, contamination=0.1, seed=42).fit_score(z, keep=[])


def _forest_scored(spark, sf):
    return _forest_of(_z(spark, sf))[1]


def fixed_forest():
    """A forest given by a rule, not fitted: eight complete trees of depth three (its twin has the same rule)."""
    import pandas as pd
    from vigilo.operators.iforest import IsolationForestModel
    rows = []
    for t in range(8):
        for i in range(15):
            inner, f = i < 7, (t + i) % 4
            cut = (0.05 * ((t * 7 + i * 3) % 20), float((t * 5 + i) % 12), float((t * 3 + i * 2) % 30), 0.01 * ((t + i) % 10))[f]
            rows.append((t, i, 2 * i + 1 if inner else -1, 2 * i + 2 if inner else -1, f if inner else -1, cut if inner else 0.0,
                         1 + (t + i) % 9, (i + 1).bit_length() - 1))
    nodes = pd.DataFrame(rows, columns=["tree", "node", "left", "right", "feature", "threshold", "size", "depth"])
    return IsolationForestModel(PRESENCE_FEATURES, 64, nodes, offset=-0.5)


@register("m3_fixed_forest")
def m3f(spark, sf):
    """Scores and decisions of a given node table over all entities, inside the plan."""
    f = presence_feats(_t(spark, sf)).fillna(0.0, ["day_of_week_variance"])
    model = fixed_forest()
    d = F.col("score") - F.lit(model.offset)
    return model.score_in_plan(f).select("id", r6("score").alias("score"), r6(d).alias("decision"), (d < 0).alias("is_flagged"))


@register("m3_decision_score")
def m3(spark, sf):
    return _forest_scored(spark, sf).select("id", "score", "decision", "is_flagged")


def flag_anomalies(spark, sf):
    """Standardise -> forest (fit + one scoring pass) -> offset -> risk -> tier."""
    d = _forest_scored(spark, sf)
    risk = TH.risk_from_decision("decision")
    return d.select(F.col("id").alias("student_id"), rint_round(risk, 2).alias("risk_score"),
                    "is_flagged", risk_tier(risk).alias("risk_level"))


register("m16_flag_anomalies")(flag_anomalies)


@register("m7_smote")
def m7(spark, sf):
    tr = _binary_train(spark, sf).select("id", "fee_default", *FP.BINARY_FEATURES)
    return S.smote(tr, "fee_default", FP.BINARY_FEATURES, minority=1, k=3, seed=42)


def _binary_model(spark, sf):
    train = _binary_train(spark, sf).select("id", "fee_default", *FP.BINARY_FEATURES)
    fit = lambda: G.fit_default_binary(S.smote(train, "fee_default", FP.BINARY_FEATURES, minority=1))
    return _artifact(spark, sf, "default_binary", G.DefaultBinaryModel.load, fit, train)


@register("m8_fit_default_binary")
def m8(spark, sf):
    m = _binary_model(spark, sf)
    test = FP.model_inputs(fee_feats(_t(spark, sf)))
    return m.predict_proba(test).select("id", "fee_default", "default_prob")


def _multi_model(spark, sf):
    train = S.class_weights(fee_feats(_t(spark, sf)), "label", "fixed", minority=2, factor=4.0)
    return _artifact(spark, sf, "status_multiclass", G.StatusMulticlassModel.load,
                     lambda: G.fit_status_multiclass(train, weight_col="weight"), train)


@register("m9_fit_status_multiclass")
def m9(spark, sf):
    m = _multi_model(spark, sf)
    return m.predict(fee_feats(_t(spark, sf))).select("id", "label", "p_0", "p_1", "p_2", "label_pred")


@register("m11_feature_importances")
def m11(spark, sf):
    return _multi_model(spark, sf).importances(spark)


@register("m12_predict_proba")
def m12(spark, sf):
    m = _multi_model(spark, sf)
    return m.predict_proba(fee_feats(_t(spark, sf))).select("id", "p_0", "p_1", "p_2")


@register("m15_score_default_risk")
def m15(spark, sf):
    return G.score_default_risk(fee_feats(_t(spark, sf)), _binary_model(spark, sf))


def _anomaly_model(spark, sf):
    feats = presence_feats(_t(spark, sf)).fillna(0.0, ["day_of_week_variance"])

    def fit():
        scaler = fit_standardizer(feats, PRESENCE_FEATURES)
        return AR.AnomalyModel(scaler, _forest_of(scaler.transform(feats))[0])
    tag = hashlib.sha1(f"{spark.sparkContext.applicationId}|{sf}".encode()).hexdigest()[:16]
    path = f"{ensure_checkpoint_dir(spark)}/models-{tag}/anomaly"
    return load_or_fit_version(spark, path, AR.load_anomaly, fit, AR.save_anomaly, feats.select("id", *PRESENCE_FEATURES))


@register("d11_score_ids_anomaly_model")
def d11m(spark, sf):
    """The requested ids only are scored, by the published model."""
    from vigilo.plans.catalog import request_ids
    t = _t(spark, sf)
    return _anomaly_model(spark, sf).flag(D.score_ids(presence_feats(t), request_ids(t)))


@register("d12_score_ids_fee_model")
def d12m(spark, sf):
    from vigilo.plans.catalog import request_ids
    t = _t(spark, sf)
    m = _multi_model(spark, sf)
    req = D.score_ids(fee_feats(t), request_ids(t))
    p = m.predict_proba(req)
    return p.select(F.col("id").alias("student_id"), rint_round(F.col("p_2"), 2).alias("default_probability"),
                    D.fee_tier("p_2").alias("risk_category"))


# ------------------------------------------------------------ what must hold of fitted models, with twins
def _held(df, **counts):
    """One row per named count: (check_name, value)."""
    row = df.agg(*[e.cast("long").alias(k) for k, e in counts.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check_name"), F.col(k).alias("value")) for k in counts])))


def _broken(cond):
    return F.count(F.when(~F.coalesce(cond, F.lit(False)), 1))


def _n():
    return F.count(F.lit(1))


@register("m2_forest_invariants")
def m2i(spark, sf):
    """Node table: trees, sample sizes at the roots, children that do not add up, nodes too deep, split leaves."""
    n = m2(spark, sf)
    child = n.select("tree", F.col("node").alias("c"), F.col("size").alias("s"), F.col("depth").alias("d"))
    inner = n.where("feature >= 0")
    both = (inner.join(child.select("tree", F.col("c").alias("left"), F.col("s").alias("ls"), F.col("d").alias("ld")), ["tree", "left"], "left")
            .join(child.select("tree", F.col("c").alias("right"), F.col("s").alias("rs"), F.col("d").alias("rd")), ["tree", "right"], "left"))
    sums = _held(both, children_do_not_add_up=_broken(F.col("ls") + F.col("rs") == F.col("size")),
                 children_at_wrong_depth=_broken((F.col("ld") == F.col("depth") + 1) & (F.col("rd") == F.col("depth") + 1)),
                 empty_children=_broken((F.col("ls") > 0) & (F.col("rs") > 0)))
    return _held(n, trees=F.count_distinct("tree"), smallest_sample=F.min(F.when(F.col("node") == 0, F.col("size"))),
                 largest_sample=F.max(F.when(F.col("node") == 0, F.col("size"))), too_deep=_broken(F.col("depth") <= 8),
                 unknown_features=_broken(F.col("feature").between(-1, 3))).unionByName(sums)


@register("m3_decision_invariants")
def m3i(spark, sf):
    d = _forest_scored(spark, sf)
    return _held(d, rows=_n(), ids=F.count_distinct("id"), scores_out_of_range=_broken((F.col("score") >= -1) & (F.col("score") < 0)),
                 flags_against_decision=_broken(F.col("is_flagged") == (F.col("decision") < 0)),
                 flagged_beyond_contamination=F.greatest(F.lit(0), F.count(F.when(F.col("is_flagged"), 1)) - F.ceil(_n() * 0.1)))


@register("m16_flag_invariants")
def m16i(spark, sf):
    f = flag_anomalies(spark, sf)
    risk = F.col("risk_score")
    return _held(f, rows=_n(), risk_out_of_range=_broken(risk.between(0, 100)), flagged_at_low_risk=_broken(~F.col("is_flagged") | (risk >= 50)),
                 high_risk_not_flagged=_broken(F.col("is_flagged") | (risk <= 50)),
                 wrong_level=_broken((F.col("risk_level") == risk_tier("risk_score")) | (F.abs(risk - 70) < 0.01) | (F.abs(risk - 40) < 0.01)))


@register("m8_binary_invariants")
def m8i(spark, sf):
    m = _binary_model(spark, sf)
    p = m.predict_proba(FP.model_inputs(fee_feats(_t(spark, sf))))
    mean = lambda c: F.avg(F.when(F.col("fee_default") == c, F.col("default_prob")))
    return _held(p, rows=_n(), iterations=F.max(F.lit(m.iterations)), probabilities_out_of_range=_broken(F.col("default_prob").between(0, 1)),
                 defaults_scored_no_higher=(~F.coalesce(mean(1) > mean(0), F.lit(True))).cast("int"))


@register("m9_status_invariants")
def m9i(spark, sf):
    """M9, M12 and M13 of the multinomial model: rounds, rising losses, probabilities, threshold rule."""
    m = _multi_model(spark, sf)
    p = m.predict(fee_feats(_t(spark, sf)))
    rule = F.when(F.col("p_2") >= 0.5, 2).when(F.col("p_0") >= F.col("p_1"), 0).otherwise(1)
    rising = sum(b > a for a, b in zip(m.losses, m.losses[1:]))
    return _held(p, rows=_n(), rounds=F.max(F.lit(m.iterations)), rising_losses=F.max(F.lit(rising)),
                 sums_not_one=_broken(F.abs(F.col("p_0") + F.col("p_1") + F.col("p_2") - 1) < 1e-9),
                 out_of_range=_broken(F.col("p_0").between(0, 1) & F.col("p_1").between(0, 1) & F.col("p_2").between(0, 1)),
                 labels_against_rule=_broken(F.col("label_pred") == rule))


@register("m11_importance_invariants")
def m11i(spark, sf):
    i = m11(spark, sf)
    return _held(i, features=F.count_distinct("feature"), ranks=F.count_distinct("rank"), negative=_broken(F.col("importance") >= 0),
                 sum_in_millionths=F.round(F.sum("importance") * 1_000_000))


@register("m15_default_risk_invariants")
def m15i(spark, sf):
    r = m15(spark, sf)
    p, border = F.col("default_probability"), lambda x: F.abs(F.col("default_probability") - x) < 0.06
    return _held(r, rows=_n(), ids=F.count_distinct("student_id"), out_of_range=_broken(p.between(0, 100)),
                 wrong_category=_broken((F.col("risk_category") == D.fee_tier(p / 100, inclusive=True)) | border(60) | border(30)),
                 wrong_decision=_broken((F.col("will_default") == (p >= 20).cast("int")) | border(20)))


@register("d11_model_invariants")
def d11i(spark, sf):
    """The request's known ids, each once, scored as the whole table is."""
    few, all_rows = d11m(spark, sf), _anomaly_model(spark, sf).flag(presence_feats(_t(spark, sf)))
    other = all_rows.toDF("student_id", "r", "f", "l")
    return _held(few.join(other, "student_id", "left"), rows=_n(), ids=F.count_distinct("student_id"),
                 scored_differently=_broken((F.col("risk_score") == F.col("r")) & (F.col("is_flagged") == F.col("f")) & (F.col("risk_level") == F.col("l"))))


@register("d12_model_invariants")
def d12i(spark, sf):
    p = F.col("default_probability")
    return _held(d12m(spark, sf), rows=_n(), ids=F.count_distinct("student_id"), out_of_range=_broken(p.between(0, 1)),
                 wrong_category=_broken((F.col("risk_category") == D.fee_tier(p)) | (F.abs(p - 0.6) < 0.006) | (F.abs(p - 0.3) < 0.006)))


@register("m13_binary_threshold_label")
def m13b(spark, sf):
    p = predictions(_t(spark, sf))
    return p.select("id", "prob", TH.binary_threshold_label("prob", G.BINARY_THRESHOLD).alias("label_pred"))
