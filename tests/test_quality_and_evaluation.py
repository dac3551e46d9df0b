"""Quality gate (null presence must fail) and evaluation golden numbers."""
import pytest
from pyspark.sql import functions as F

from vigilo.operators import evaluation as E
from vigilo.operators import quality as Q


def _att(spark, rows):
    return spark.createDataFrame(rows, "student_id string, attendance_rate double, longest_absence_streak int, "
                                       "absence_in_last_30_days int, day_of_week_variance double, is_anomaly int")


def test_gate_passes_and_fails(spark):
    good = _att(spark, [("a", 0.9, 1, 2, 0.01, 0), ("b", 0.6, 9, 12, 0.02, 1), ("c", 0.95, 0, 1, 0.0, 0)])
    gate = {r["tbl"]: r["passed"] for r in Q.quality_gate(Q.presence_checks(good)).collect()}
    assert gate["all"] is True
    bad = _att(spark, [("a", None, 1, 2, 0.01, 0), ("b", 0.6, 9, 12, float("nan"), 1)])
    checks = Q.presence_checks(bad)
    nulls = {r["col"]: r["observed"] for r in checks.filter("check_name = 'nulls'").collect()}
    assert nulls["attendance_rate"] == 1 and nulls["day_of_week_variance"] == 1
    assert {r["tbl"]: r["passed"] for r in Q.quality_gate(checks).collect()}["all"] is False


def _pred(spark, tn, fp, fn, tp):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(rows)], "id long, y_true int, y_pred int")


def test_binary_metrics_golden(spark):
    m = E.binary_metrics(_pred(spark, 424, 6, 26, 44)).first()
    assert (m["recall"], m["precision"], m["f1"], m["accuracy"]) == pytest.approx((0.6286, 0.88, 0.7333, 0.936), abs=1e-4)
    cm = {r["actual"]: (r["pred_0"], r["pred_1"]) for r in E.confusion_matrix(_pred(spark, 424, 6, 26, 44)).collect()}
    assert cm == {0: (424, 6), 1: (26, 44)}


def test_zero_division_and_empty_cells(spark):
    m = E.binary_metrics(_pred(spark, 5, 0, 3, 0)).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0


def test_report_matches_sklearn_definition(spark):
    rows = [(0, 0), (0, 1), (1, 1), (2, 2), (2, 0), (2, 2), (1, 1), (0, 0)]
    df = spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(rows)], "id long, y_true int, y_pred int")
    rep = {r["label"]: r for r in E.classification_report(df).collect()}
    assert rep["0"]["precision"] == pytest.approx(2 / 3) and rep["2"]["recall"] == pytest.approx(2 / 3)
    assert rep["accuracy"]["f1"] == pytest.approx(6 / 8)
    assert rep["macro avg"]["support"] == 8


def test_auc_exact_with_ties(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.2), (0, 0.1)]
    df = spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(rows)], "id long, y_true int, prob double")
    # pairs: pos {0.9, 0.8, 0.2} vs neg {0.8, 0.3, 0.1}: 3 + (0.5 + 1 + 1) + 1 = 6.5 of 9
    assert E.roc_auc(df).first()["auc"] == pytest.approx(6.5 / 9)


def test_prefix_sums_many_partitions(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    got = E.prefix_sums(df, "k", ["v"], partitions=7).select("k", "below_v").collect()
    assert all(r["below_v"] == r["k"] for r in got)


def test_positions_are_a_permutation_on_cached_input_with_ties(spark):
    # a third of the rows share one value of the leading order column
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(5.0))
                                  .otherwise(F.col("id") / 7.0).alias("v")).repartition(9).persist()
    df.count()
    pos = E.dense_positions(df, ["v", "id"]).select("id", "v", "pos").toPandas()
    assert sorted(pos["pos"]) == list(range(3000))
    want = pos.sort_values(["v", "id"])["id"].tolist()
    assert pos.sort_values("pos")["id"].tolist() == want


def test_unique_key_precondition(spark):
    import datetime as dt
    d = dt.date(2024, 1, 1)
    ok = spark.createDataFrame([("a", d, 1), ("a", d + dt.timedelta(days=1), 0)], "id string, date date, is_present int")
    bad = ok.unionByName(ok.limit(1))
    assert Q.check_unique(ok, ["id", "date"], "presence").first()["passed"] is True
    r = Q.check_unique(bad, ["id", "date"], "presence").first()
    assert r["passed"] is False and r["observed"] == 2


def test_missing_columns_and_null_ids_fail(spark):
    from vigilo.operators import quality as Q
    fee = spark.createDataFrame([(None, 1.0, 0, 2.0, 0, 1, 1), (2, 1.0, 0, 2.0, 0, 1, 1)],
                                "student_id int, days_since_last_payment double, previous_term_status int, total_outstanding double, "
                                "income_encoded int, transport_user int, sibling_count int")
    rows = {(r.check_name, r.col): r for r in Q.period_checks(fee).collect()}
    assert not rows[("required_columns", None)].passed and rows[("required_columns", None)].observed == 1
    assert rows[("nulls", "student_id")].observed == 1 and not rows[("nulls", "student_id")].passed
    assert not rows[("min", "label")].passed and rows[("min", "label")].observed is None
    assert rows[("min", "sibling_count")].passed
    plan = Q.period_checks(fee, kinds=("required",))._jdf.queryExecution().optimizedPlan().toString()
    assert "student_id" not in plan.replace("student_id as", "")


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    from vigilo.sources.readers import read_presence
    p = tmp_path / "p.csv"
    p.write_text("is_present,student_id,date\n1,STU_001,2023-08-01\n")
    assert tuple(read_presence(spark, str(p)).select("student_id", "is_present").first()) == ("STU_001", 1)
    p.write_text("student_id,date\nSTU_001,2023-08-01\n")
    with pytest.raises(ValueError):
        read_presence(spark, str(p))


def test_split_is_exact_per_class_and_has_no_key_limit(spark):
    from pyspark.sql import functions as F
    from vigilo.operators.sampling import stratified_split
    df = spark.range(4_000_000_000, 4_000_010_000).select("id", F.when(F.col("id") % 1000 == 0, "rare").otherwise("common").alias("y"))
    got = {(r.y, r.split): r["count"] for r in stratified_split(df, "y").groupBy("y", "split").count().collect()}
    assert got == {("rare", "test"): 2, ("rare", "train"): 8, ("common", "test"): 1998, ("common", "train"): 7992}


def test_oversampling_needs_enough_minority_rows(spark):
    from pyspark.sql import functions as F
    from vigilo.operators.sampling import smote
    df = spark.range(10).select("id", (F.col("id") == 0).cast("int").alias("y"), F.col("id").cast("double").alias("a"))
    with pytest.raises(ValueError):
        smote(df, "y", ["a"])
    df = spark.range(100).select("id", (F.col("id") < 5).cast("int").alias("y"), F.col("id").cast("double").alias("a"))
    out = smote(df, "y", ["a"])
    assert out.where("y = 1").count() == 95 and out.where("synthetic").where("a < 0 or a > 4").count() == 0
