"""S7–S9 artifacts and the batch job end to end (small scale, few iterations)."""
import os

import pytest
from pyspark.sql import functions as F

from vigilo.operators.iforest import IsolationForest
from vigilo.sources import artifacts as AR

SF = "/root/testdata/sf0.001"


def test_forest_save_load_and_load_or_fit(spark, tmp_path):
    df = spark.range(300).select(F.col("id"), (F.col("id") % 17).cast("double").alias("a"),
                                 (F.col("id") % 5).cast("double").alias("b"))
    calls = []

    def fit():
        calls.append(1)
        return IsolationForest(["a", "b"], n_trees=10, seed=3).fit(df)
    path = str(tmp_path / "forest")
    m1 = AR.load_or_fit(spark, path, AR.load_forest, fit, AR.save_forest)
    m2 = AR.load_or_fit(spark, path, AR.load_forest, fit, AR.save_forest)
    assert len(calls) == 1                       # second call loads
    assert m2.offset == pytest.approx(m1.offset) and m2.psi == m1.psi
    s1 = {r["id"]: r["score"] for r in m1.score_samples(df).collect()}
    s2 = {r["id"]: r["score"] for r in m2.score_samples(df).collect()}
    assert s1 == s2


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
def test_batch_job_end_to_end(spark, tmp_path):
    from vigilo.plans.batch_job import run_batch_job
    from vigilo.sources.adapters import TestTables, anomaly_labels
    t = TestTables(spark, SF)
    out = str(tmp_path / "run")
    r = run_batch_job(spark, t.presence, t.periods, t.dim, anomaly_labels(t.presence), out, gbt_iters=3, n_trees=20)
    prof = r.profile
    assert prof.count() == t.presence.select("id").distinct().count()
    assert set(prof.columns) >= {"id", "name", "student_class", "risk_score", "fee_prob", "is_anomaly"}
    bad = prof.filter((F.col("risk_score") < 0) | (F.col("risk_score") > 100) | (F.col("fee_prob") < 0)
                      | (F.col("fee_prob") > 100)).count()
    assert bad == 0
    gate = {x["tbl"]: x["passed"] for x in r.gate.collect()}
    assert set(gate) == {"attendance_features", "fee_features", "presence", "periods", "all"}
    assert gate["presence"] and gate["periods"]            # key preconditions hold on the adapters
    for name in ("status_report", "default_binary_metrics", "status_importances", "anomaly_gate",
                 "default_threshold_scan", "default_threshold_pick", "default_risk_scores"):
        assert spark.read.parquet(f"{out}/evaluation/{name}").count() > 0
    for name in ("anomaly_confusion", "anomaly_report", "anomaly_top_flagged"):
        assert spark.read.parquet(f"{out}/evaluation/{name}").count() > 0
    from vigilo.sources.versions import newest_whole
    for model in ("anomaly", "default_binary", "status_multiclass"):
        assert newest_whole(spark, f"{out}/models/{model}") is not None
    from vigilo.operators.profile import history
    store = spark.read.parquet(f"{out}/presence_history")
    h = history(store, 3, n=5)
    assert "EqualTo(id,3)" in h._jdf.queryExecution().executedPlan().toString()   # pushed to the scan
    assert [r["date"] for r in h.collect()] == sorted(r["date"] for r in h.collect()) and h.count() == 5


def test_run_from_reference_style_csv(spark, tmp_path):
    import datetime as dt
    from vigilo.plans.run import main
    pres = ["student_id,date,is_present"]
    for s in range(1, 31):
        for d in range(40):
            day = dt.date(2023, 8, 1) + dt.timedelta(days=d)
            pres.append(f"STU_{s:03d},{day.isoformat()},{0 if (s * 7 + d) % (3 + s % 5) == 0 else 1}")
    (tmp_path / "presence.csv").write_text("\n".join(pres) + "\n")
    per = ["student_id,term,status,days_since_last_payment,family_income_bracket,transport_user,sibling_count,total_outstanding"]
    for s in range(1, 31):
        for t in (1, 2, 3):
            st = (s + t) % 3
            per.append(f"STU_{s:03d},{t},{st},{[0, 20, 60][st]},{['High', 'Medium', 'Low'][s % 3]},{s % 2},{s % 4},{[0, 900, 3000][st]}")
    (tmp_path / "periods.csv").write_text("\n".join(per) + "\n")
    lab = ["student_id,class,is_anomaly"] + [f"STU_{s:03d},{['6A', '10B'][s % 2]},{1 if s % 7 == 0 else 0}" for s in range(1, 31)]
    (tmp_path / "labels.csv").write_text("\n".join(lab) + "\n")
    r = main(["--presence", str(tmp_path / "presence.csv"), "--periods", str(tmp_path / "periods.csv"),
              "--labels", str(tmp_path / "labels.csv"), "--out", str(tmp_path / "out"), "--gbt-iters", "3",
              "--trees", "20"], spark=spark)
    prof = {x["id"]: x for x in r.profile.collect()}
    assert len(prof) == 30 and prof["STU_001"]["name"] == "Aarav Sharma" and prof["STU_002"]["student_class"] == "6A"


def test_fee_models_save_load_and_threshold(spark, tmp_path):
    from vigilo.operators import boosting as G
    df = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                 (F.col("id") % 3).cast("int").alias("label"), (F.col("id") % 2).cast("int").alias("y"))
    binary = G.fit_default_binary(df, ["a", "b"], "y", maxIter=4).with_threshold(0.35)
    binary.save(str(tmp_path / "b"))
    again = G.DefaultBinaryModel.load(spark, str(tmp_path / "b"))
    assert again.threshold == 0.35 and again.features == ["a", "b"] and again.iterations == binary.iterations == 4
    assert ({r.id: r.default_prob for r in binary.predict_proba(df).collect()}
            == {r.id: r.default_prob for r in again.predict_proba(df).collect()})
    status = G.fit_status_multiclass(df, ["a", "b"], maxIter=3)
    status.save(str(tmp_path / "s"))
    again = G.StatusMulticlassModel.load(spark, str(tmp_path / "s"))
    assert again.iterations == 3 and again.classes == (0, 1, 2) and again.threshold == status.threshold
    assert ({r.id: (r.p_0, r.p_2, r.label_pred) for r in status.predict(df).collect()}
            == {r.id: (r.p_0, r.p_2, r.label_pred) for r in again.predict(df).collect()})


def test_full_iteration_budget_is_the_default():
    from vigilo.operators import boosting as G
    assert G.BINARY_PARAMS["maxIter"] == 500 and G.MULTICLASS_PARAMS["maxIter"] == 200


def test_scaler_and_forest_stay_together(spark, tmp_path):
    """A second run on other data loads both parts or fits both."""
    from vigilo.operators.scaling import fit_standardizer
    feats = ["a", "b"]

    def frame(scale):
        return spark.range(300).select("id", ((F.col("id") % 17) * scale).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))

    def fit(df):
        scaler = fit_standardizer(df, feats)
        return AR.AnomalyModel(scaler, IsolationForest(feats, n_trees=10, seed=3).fit(scaler.transform(df)))
    path = str(tmp_path / "anomaly")
    first = AR.load_or_fit(spark, path, AR.load_anomaly, lambda: fit(frame(1)), AR.save_anomaly)
    second = AR.load_or_fit(spark, path, AR.load_anomaly, lambda: fit(frame(1000)), AR.save_anomaly)
    assert sorted(second.scaler.to_rows()) == sorted(first.scaler.to_rows()) and second.forest.offset == first.forest.offset
    new = frame(1).limit(40)
    assert sorted(map(tuple, first.flag(new).collect())) == sorted(map(tuple, second.flag(new).collect()))
    assert set(first.flag(new).columns) == {"student_id", "risk_score", "is_flagged", "risk_level"}


def test_unreadable_artifacts_are_not_overwritten(spark, tmp_path):
    path = tmp_path / "x"
    path.mkdir()

    def broken(_, __):
        raise PermissionError("no access")
    with pytest.raises(PermissionError):
        AR.load_or_fit(spark, str(path), broken, lambda: 1, lambda *a: None)
