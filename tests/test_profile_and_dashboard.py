"""Profile defaults, tiers at exact boundaries, literal search, semi-join, histogram, health."""
import pytest
from pyspark.sql import functions as F

from vigilo.functions import fee_tier, risk_tier, rint_round
from vigilo.operators import analytics as B
from vigilo.operators import profile as D


@pytest.fixture(scope="module")
def prof(spark):
    att = spark.createDataFrame(
        [(1, 81 / 144, 5, 9, 75.0, True), (2, 0.9, 1, 2, 40.0, False), (3, 0.95, 0, 0, 70.0, False),
         (4, 0.45, 12, 20, 70.04, True)],
        "id long, attendance_rate double, longest_absence_streak int, absence_in_last_30_days int, "
        "risk_raw double, is_anomaly_pred boolean")
    fee = spark.createDataFrame([(1, 0.3, 2, 1234.5, 39.5), (2, 0.6, 1, 10.0, 12.0), (3, 0.1, 0, 0.0, 0.0)],
                                "id long, default_prob double, label_pred int, total_outstanding double, "
                                "days_since_last_payment double")
    dim = spark.createDataFrame([(1, "10A"), (2, "6A")], "id long, class string")
    return D.build_profile(att, fee, dim).persist()


def test_profile_rows(prof):
    got = {r["id"]: r for r in prof.collect()}
    assert got[1]["attendance_rate"] == 56.2           # 56.25 -> half-even
    assert got[1]["days_late"] == 39                   # truncation
    assert got[4]["fee_prob"] == 0.0 and got[4]["fee_label"] == 0 and got[4]["outstanding"] == 0.0  # no fee row
    assert got[3]["student_class"] == "7A"             # fallback from the id: classes[(3-1) mod 10]
    assert got[1]["name"] == "Aarav Sharma" and got[4]["name"] == "Anjali Singh"


def test_tier_boundaries(spark):
    df = spark.createDataFrame([(40.0, 0.3), (70.0, 0.6), (70.04, 0.61)], "r double, p double")
    rows = df.select(risk_tier("r").alias("t"), fee_tier("p").alias("f"), fee_tier("p", True).alias("fb")).collect()
    assert [r["t"] for r in rows] == ["Low", "Medium", "High"]        # strict
    assert [r["f"] for r in rows] == ["Low", "Medium", "High"]        # strict online
    assert [r["fb"] for r in rows] == ["MEDIUM", "HIGH", "HIGH"]      # inclusive batch
    # dashboard tiers use the rounded value: 70.04 -> 70.0 -> Medium
    assert df.select(risk_tier(rint_round(F.col("r"), 1)).alias("t")).collect()[2]["t"] == "Medium"


def test_search_is_literal(prof):
    assert D.search(prof, "%").count() == 0
    assert D.search(prof, "_").count() == 0
    assert {r["id"] for r in D.search(prof, "AAR").collect()} == {1}


def test_semi_join_dedup_and_unknown(spark, prof):
    ids = spark.createDataFrame([(1,), (1,), (99,)], "x long")
    assert [r["id"] for r in D.score_ids(prof, ids).collect()] == [1]


def test_histogram_keeps_empty_buckets(prof):
    h = B.rate_histogram(prof).orderBy("position").collect()
    assert [r["bucket"] for r in h] == ["0-50%", "50-60%", "60-70%", "70-80%", "80-90%", "90-100%"]
    assert [r["students"] for r in h] == [1, 1, 0, 0, 0, 2]


def test_health_and_landing(spark, prof):
    k = B.kpis(prof).first()
    assert k["total"] == 4 and k["landing_safe"] == max(0, 4 - k["anomalies"] - k["fee_defaults"])
    empty = prof.limit(0)
    assert B.health_score(empty).count() == 0


def test_health_golden(spark):
    # 500 entities, 0 high risk, 252 defaults -> 69.8
    df = spark.range(500).select(F.col("id"), F.lit(10.0).alias("risk_score"), F.lit(False).alias("is_anomaly"),
                                 F.when(F.col("id") < 252, 2).otherwise(0).alias("fee_label"))
    assert B.health_score(df).first()["system_health"] == 69.8


def test_reasons_and_display(prof):
    r = {x["id"]: x for x in D.risk_reasons(prof).collect()}
    assert r[3]["no_risk"] and not r[1]["no_risk"]
    assert any("consecutive absence streak" in s for s in r[4]["attendance_reasons"])
    d = {x["id"]: x for x in D.with_display(prof).collect()}
    assert d[1]["overall_status"] == "Critical" and d[3]["overall_status"] == "At Risk"
    assert d[1]["initials"] == "AS" and d[1]["fee_status"] == "Default"


def test_page_and_keyset(prof):
    p1 = [r["id"] for r in D.page(prof, 1, "risk_desc", size=2).collect()]
    p2 = [r["id"] for r in D.page(prof, 2, "risk_desc", size=2).collect()]
    assert p1 == [1, 3] and p2 == [4, 2]          # 70.04 rounds to 70.0: tie broken by id
    last = prof.filter("id = 3").first()
    k2 = [r["id"] for r in D.keyset_page(prof, "risk_desc", (last["risk_score"], 3), size=2).collect()]
    assert k2 == p2


def test_alert_feed_precedence_and_class_sort(spark):
    df = spark.createDataFrame(
        [(i, f"N{i}", c, 50.0, a, 55.5, 0, 0, fl, 70.1, 0.0, 0)
         for i, c, a, fl in [(1, "6A", True, 2), (2, "10A", False, 2), (3, "9B", False, 0), (4, "6A", True, 0)]],
        "id long, name string, student_class string, attendance_rate double, is_anomaly boolean, risk_score double, "
        "absence_streak int, absence_30d int, fee_label int, fee_prob double, outstanding double, days_late int")
    feed = B.alert_feed(df).collect()
    assert [(r["id"], r["type"]) for r in feed] == [(1, "Attendance Anomaly"), (2, "Fee Default"), (4, "Attendance Anomaly")]
    assert feed[0]["detail"] == "Risk 55.5" and feed[1]["detail"] == "70.1% default prob"
    assert [r["class"] for r in B.class_breakdown(df).collect()] == ["10A", "6A", "9B"]   # string order


def test_topk_salted_equals_group_limit(spark):
    from vigilo.operators.topk import top_k_per_group
    df = spark.range(3000).select((F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 50)).alias("g"),
                                  F.col("id"), (F.pmod(F.xxhash64("id"), F.lit(997))).alias("v"))
    order = [F.desc("v"), F.asc("id")]
    a = top_k_per_group(df, ["g"], order, 4).select("g", "id", "rank")
    b = top_k_per_group(df, ["g"], order, 4, salt_buckets=16).select("g", "id", "rank")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.filter("g = 0").count() == 4


def test_analytics_bundle_equals_its_parts(prof):
    rows = {}
    for r in B.analytics_bundle(prof, top=2).collect():
        rows.setdefault(r["part"], {})[r["key"], r["metric"]] = r["value"]
    assert set(rows) == set(B.BUNDLE_PARTS)
    k = B.kpis(prof).first()
    assert rows["totals"] == {("all", m): str(k[c]) for m, c in B.TOTAL_FIELDS.items()}
    assert rows["system_health"] == {("all", "system_health"): str(k["system_health"])}
    assert rows["risk_distribution"] == {(r["tier"], "count"): str(r["students"]) for r in B.risk_distribution(prof).collect()}
    assert rows["fee_distribution"] == {(r["status"], "count"): str(r["students"]) for r in B.fee_distribution(prof).collect()}
    assert rows["attendance_histogram"] == {(r["bucket"], "count"): str(r["students"]) for r in B.rate_histogram(prof).collect()}
    assert rows["class_breakdown"] == {(r["class"], m): str(r[m]) for r in B.class_breakdown(prof).collect()
                                       for m in ("total", "anomalies", "defaults", "late")}
    text = lambda v: str(v).lower() if isinstance(v, bool) else str(v)
    assert rows["top_risk_students"] == {(str(i + 1), m): text(r[m]) for i, r in enumerate(B.top_n(prof, 2).collect()) for m in B.TOP_FIELDS}
    assert rows["recent_activity"] == {(str(i + 1), m): text(r[m]) for i, r in enumerate(B.alert_feed(prof).collect())
                                       for m in B.ACTIVITY_FIELDS}


def test_analytics_bundle_scans_the_profile_once_and_keeps_ties_in_id_order(spark, tmp_path):
    fields = ("id long, name string, student_class string, attendance_rate double, is_anomaly boolean, risk_score double, "
              "absence_streak int, absence_30d int, fee_label int, fee_prob double, outstanding double, days_late int")
    rows = [(i, f"n{i}", None if i % 5 == 0 else f"c{i % 3}", 40.0 + i % 60, i % 2 == 0, 50.0, 0, 0, i % 4, 10.0, 0.0, 0) for i in range(1, 400)]
    spark.createDataFrame(rows, fields).repartition(6).write.parquet(f"{tmp_path}/p")
    bundle = B.analytics_bundle(spark.read.parquet(f"{tmp_path}/p"), top=5)
    plan = bundle._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "InMemoryRelation" not in plan and "InMemoryTableScan" not in plan
    got = {(r["key"], r["metric"]): r["value"] for r in bundle.where("part = 'top_risk_students'").collect()}
    assert [got[str(k), "id"] for k in range(1, 6)] == ["1", "2", "3", "4", "5"]   # all scores equal
    classes = {r["key"]: int(r["value"]) for r in bundle.where("part = 'class_breakdown' and metric = 'total'").collect()}
    assert sum(classes.values()) == 399 and classes["Unknown"] == 79
    assert B.analytics_bundle(spark.createDataFrame([], fields)).collect() == []
    with pytest.raises(ValueError):
        B.analytics_bundle(bundle, top=None)


def test_cluster_conf():
    from vigilo.session import cluster_conf
    c = cluster_conf(100 << 40, executor_cores=8, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600 and "spark.checkpoint.dir" not in c


def test_entity_detail_unknown_and_nested(spark, prof):
    import datetime as dt
    pres = spark.createDataFrame([(1, dt.date(2024, 1, d), d % 2) for d in range(1, 6)],
                                 "id long, date date, is_present int")
    d = D.entity_detail(prof, pres, 1, n=3).first()
    assert [h["date"].day for h in d["history"]] == [3, 4, 5]
    assert D.entity_detail(prof, pres, 999).count() == 0
    assert D.entity_detail(prof, pres, 2).first()["history"] == []
