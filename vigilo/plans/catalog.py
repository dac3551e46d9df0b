"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables (or tables Spark derives from them).
Floating outputs are rounded half-even at 6 decimals so the DuckDB twin in
``vigilo.plans.oracle`` compares bit-for-bit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.functions import rint_round
from vigilo.operators import analytics as B
from vigilo.operators import evaluation as E
from vigilo.operators import periods as FP
from vigilo.operators import presence as A
from vigilo.operators import presence_segments as PS
from vigilo.operators import profile as D
from vigilo.operators import quality as Q
from vigilo.sources.adapters import TestTables, anomaly_labels

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

# Parameters of the registered queries (inputs, not caps).
RECENT_N_TEST = 10          # last-n records (the test calendar has 30 days)
APPEND_SEGMENT_DAYS = 8     # short segments, so that the test calendar has several
LOOKUP_ID = 42
SEARCH_TEXT = "ar"
PAGE_NUMBER = 2
REQUEST_PRIORITY = "1-URGENT"  # request ids = customers of urgent orders (dups + unknown ids)


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def r6(c) -> F.Column:
    return rint_round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- shared tables
def _t(spark, sf) -> TestTables:
    return TestTables(spark, sf)


def presence_feats(t: TestTables) -> DataFrame:
    return A.presence_features(t.presence)


def att_table(t: TestTables) -> DataFrame:
    """Presence feature table with the reference's column names and the test label.

    The test label (rate below 0.85) is a function of the features, so it is
    added as a column instead of re-aggregating the presence grid for a join;
    the A6 query exercises the label join itself.
    """
    f = presence_feats(t)
    f = f.withColumn("is_anomaly", (F.col("attendance_rate") < F.lit(0.85)).cast("int"))
    return f.withColumnRenamed("id", "student_id")


def fee_feats(t: TestTables) -> DataFrame:
    return FP.period_features(t.periods)


def fee_table(t: TestTables) -> DataFrame:
    return fee_feats(t).withColumnRenamed("id", "student_id")


def profile(t: TestTables) -> DataFrame:
    att = D.surrogate_anomaly_scores(presence_feats(t))
    fee = D.surrogate_fee_scores(fee_feats(t))
    # the profile's left join keeps only presence entities, so the class side needs no events scan
    return D.build_profile(att, fee, t.class_dim)


def predictions(t: TestTables) -> DataFrame:
    """(id, y_true, y_pred, prob): default vs worst previous status, surrogate probability."""
    f = D.surrogate_fee_scores(fee_feats(t))
    return f.select("id", (F.col("label") == 2).cast("int").alias("y_true"),
                    (F.col("previous_term_status") == 2).cast("int").alias("y_pred"),
                    (rint_round(F.lit(100.0) * F.col("default_prob"), 1) / F.lit(100.0)).alias("prob"),
                    F.col("label").alias("label"), F.col("previous_term_status").alias("ps"))


def request_ids(t: TestTables) -> DataFrame:
    o = t.raw("orders")
    return o.filter(F.col("o_orderpriority") == REQUEST_PRIORITY).select(F.col("o_custkey").alias("id"))


# ---------------------------------------------------------------- S: sources
@register("s1_read_presence")
def s1(spark, sf):
    return _t(spark, sf).presence


@register("s2_read_periods")
def s2(spark, sf):
    return _t(spark, sf).periods


@register("s3_entity_dim")
def s3(spark, sf):
    return _t(spark, sf).dim


# ---------------------------------------------------------------- A: presence
@register("a0_business_days")
def a0(spark, sf):
    return A.business_days(_t(spark, sf).presence)


@register("a1_presence_rate")
def a1(spark, sf):
    return A.presence_rate(_t(spark, sf).presence).select("id", r6("attendance_rate").alias("attendance_rate"))


@register("a2_longest_absence_streak")
def a2(spark, sf):
    return A.longest_absence_streak(_t(spark, sf).presence)


@register("a3_absences_last_n")
def a3(spark, sf):
    return A.absences_in_last_n(_t(spark, sf).presence, n=RECENT_N_TEST)


@register("a4_weekday_variance")
def a4(spark, sf):
    return A.weekday_presence_variance(_t(spark, sf).presence).select(
        "id", r6("day_of_week_variance").alias("day_of_week_variance"))


@register("a5_presence_features")
def a5(spark, sf):
    return presence_feats(_t(spark, sf)).select(
        "id", r6("attendance_rate").alias("attendance_rate"), "longest_absence_streak",
        "absence_in_last_30_days", r6("day_of_week_variance").alias("day_of_week_variance"))


@register("a5_segment_summaries")
def a5s(spark, sf):
    """A5 from merged date segments: the rows of a5_presence_features."""
    f = PS.presence_features_by_segments(_t(spark, sf).presence)
    return f.select("id", r6("attendance_rate").alias("attendance_rate"), "longest_absence_streak",
                    "absence_in_last_30_days", r6("day_of_week_variance").alias("day_of_week_variance"))


@register("a5_appended_days")
def a5a(spark, sf):
    """A5 after the last week arrives: summaries of the earlier days, then only the segments of the new days again."""
    presence = _t(spark, sf).presence
    last = presence.agg(F.max("date")).first()[0]
    new = F.col("date") > F.date_sub(F.lit(last).cast("date"), 7)
    history, arrived = presence.where(~new), presence.where(new)
    stored = PS.segment_summaries(history, segment_days=APPEND_SEGMENT_DAYS)
    now = PS.append_records(stored, history, arrived, segment_days=APPEND_SEGMENT_DAYS)
    f = PS.features_from_summary(PS.merge_segments(now))
    return f.select("id", r6("attendance_rate").alias("attendance_rate"), "longest_absence_streak",
                    "absence_in_last_30_days", r6("day_of_week_variance").alias("day_of_week_variance"))


@register("a6_attach_labels")
def a6(spark, sf):
    t = _t(spark, sf)
    labelled = A.attach_labels(presence_feats(t), anomaly_labels(t.presence)).withColumnRenamed("id", "student_id")
    return labelled.select(
        "student_id", r6("attendance_rate").alias("attendance_rate"), "longest_absence_streak",
        "absence_in_last_30_days", r6("day_of_week_variance").alias("day_of_week_variance"), "is_anomaly")


# ---------------------------------------------------------------- F: periods
@register("f1_split_latest")
def f1(spark, sf):
    return FP.split_latest(_t(spark, sf).periods)


@register("f2_history_avg_days")
def f2(spark, sf):
    return FP.history_avg_days(_t(spark, sf).periods)


@register("f3_history_worst_status")
def f3(spark, sf):
    return FP.history_worst_status(_t(spark, sf).periods)


@register("f4_history_avg_outstanding")
def f4(spark, sf):
    return FP.history_avg_outstanding(_t(spark, sf).periods)


@register("f5_encode_income")
def f5(spark, sf):
    from vigilo.functions import encode_ordinal
    p = _t(spark, sf).periods
    return p.select("id", "term", encode_ordinal("family_income_bracket").alias("income_encoded"))


@register("f6_period_features")
def f6(spark, sf):
    return fee_feats(_t(spark, sf))


def _inputs(spark, sf):
    return FP.model_inputs(fee_feats(_t(spark, sf)))


@register("f7_default_target")
def f7(spark, sf):
    return _inputs(spark, sf).select("id", "label", "fee_default")


@register("f8_is_low_income")
def f8(spark, sf):
    return _inputs(spark, sf).select("id", "income_encoded", "is_low_income")


@register("f9_has_many_siblings")
def f9(spark, sf):
    return _inputs(spark, sf).select("id", "sibling_count", "has_many_siblings")


@register("f10_was_late_or_worse")
def f10(spark, sf):
    return _inputs(spark, sf).select("id", "previous_term_status", "was_late_or_worse")


@register("f11_days_x_outstanding")
def f11(spark, sf):
    return _inputs(spark, sf).select("id", r6("days_x_outstanding").alias("days_x_outstanding"))


# ---------------------------------------------------------------- Q: quality
def _checks(t: TestTables, *kinds: str) -> DataFrame:
    kinds = kinds or Q.KINDS
    return Q.presence_checks(att_table(t), kinds=kinds).unionByName(Q.period_checks(fee_table(t), kinds=kinds))


def _r6_rows(c: DataFrame) -> DataFrame:
    return c.select("tbl", "check_name", "col", r6("observed").alias("observed"), r6("bound").alias("bound"),
                    "severity", "passed")


@register("q1_required_columns")
def q1(spark, sf):
    """Both feature tables, and the fee table without its label: that one must fail."""
    t = _t(spark, sf)
    bare = Q.period_checks(fee_table(t).drop("label"), "fee_features_unlabelled", kinds=("required",))
    return _r6_rows(_checks(t, "required").unionByName(bare))


@register("q2_null_counts")
def q2(spark, sf):
    """Both feature tables, and the fee table with every 7th id (and its days) missing: that one must fail."""
    t = _t(spark, sf)
    fee = fee_table(t)
    gone = F.pmod(F.col("student_id"), F.lit(7)) == 0
    holes = fee.withColumns({c: F.when(~gone, F.col(c)) for c in ("student_id", "days_since_last_payment")})
    return _r6_rows(_checks(t, "nulls").unionByName(Q.period_checks(holes, "fee_features_holes", kinds=("nulls",))))


@register("q3_ranges")
def q3(spark, sf):
    return _r6_rows(_checks(_t(spark, sf), "ranges"))


@register("q4_label_distribution")
def q4(spark, sf):
    t = _t(spark, sf)
    d = Q.label_distribution(att_table(t), "is_anomaly", "attendance_features").unionByName(
        Q.label_distribution(fee_table(t), "label", "fee_features"))
    return d.select("tbl", "label", "n", r6("pct").alias("pct"))


@register("q4_label_band")
def q4b(spark, sf):
    return _r6_rows(_checks(_t(spark, sf), "band"))


@register("q5_group_means")
def q5(spark, sf):
    return _r6_rows(_checks(_t(spark, sf), "means"))


@register("q6_monotone_means")
def q6(spark, sf):
    return _r6_rows(_checks(_t(spark, sf), "monotone"))


@register("q7_top_anomalies")
def q7(spark, sf):
    top = Q.sample_top_anomalies(att_table(_t(spark, sf)))
    return top.select("student_id", r6("attendance_rate").alias("attendance_rate"), "longest_absence_streak",
                      "absence_in_last_30_days")


@register("q8_quality_gate")
def q8(spark, sf):
    return Q.quality_gate(_checks(_t(spark, sf)))


# ---------------------------------------------------------------- E: evaluation
@register("e1_confusion_matrix")
def e1(spark, sf):
    return E.confusion_matrix(predictions(_t(spark, sf)))


@register("e2_binary_metrics")
def e2(spark, sf):
    m = E.binary_metrics(predictions(_t(spark, sf)))
    return m.select("tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("recall", "precision", "f1", "accuracy")])


def _multi(t):
    p = predictions(t)
    return p.select("id", F.col("label").alias("y_true"), F.col("ps").alias("y_pred"))


@register("e3_classification_report")
def e3(spark, sf):
    r = E.classification_report(_multi(_t(spark, sf)), names=["On Time", "Late", "Default"])
    return r.select("label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("e4_roc_auc")
def e4(spark, sf):
    return E.roc_auc(predictions(_t(spark, sf))).select(r6("auc").alias("auc"))


@register("e5_class_recall")
def e5(spark, sf):
    return E.class_recall(_multi(_t(spark, sf)), 2).select("class", r6("recall").alias("recall"), "support")


@register("e6_target_gate")
def e6(spark, sf):
    g = E.target_gate(E.class_recall(_multi(_t(spark, sf)), 2), "fee_default", "recall", 0.70)
    return g.select("model", "metric", r6("value").alias("value"), "minimum", "passed")


@register("e7_top_flagged")
def e7(spark, sf):
    t = _t(spark, sf)
    s = D.surrogate_anomaly_scores(A.attach_labels(presence_feats(t), anomaly_labels(t.presence)))
    s = s.select("id", "attendance_rate", F.col("risk_raw").alias("risk_score"), "longest_absence_streak",
                 "absence_in_last_30_days", "is_anomaly", F.col("is_anomaly_pred").alias("is_flagged"))
    top = E.top_flagged(s)
    return top.select("id", r6("attendance_rate").alias("attendance_rate"), r6("risk_score").alias("risk_score"),
                      "longest_absence_streak", "absence_in_last_30_days", "verdict")


@register("e8_top_default")
def e8(spark, sf):
    s = D.surrogate_fee_scores(fee_feats(_t(spark, sf)))
    top = E.top_default(s)
    return top.select("id", r6("default_prob").alias("default_prob"), "total_outstanding", "days_late",
                      "previous_status", "verdict")


@register("e9_target_summary")
def e9(spark, sf):
    s = E.target_summary(FP.model_inputs(fee_feats(_t(spark, sf))))
    return s.select("rows", "positives", r6("positive_pct").alias("positive_pct"))


# ---------------------------------------------------------------- D: profile
@register("d1_risk_tier")
def d1(spark, sf):
    return D.with_tiers(profile(_t(spark, sf))).select("id", "risk_tier")


@register("d2_fee_tier")
def d2(spark, sf):
    return D.with_tiers(profile(_t(spark, sf))).select("id", "fee_tier", "fee_tier_batch")


@register("d3_build_profile")
def d3(spark, sf):
    return profile(_t(spark, sf))


@register("d4_assign_by_modulo")
def d4(spark, sf):
    from vigilo.functions import name_from_id, class_from_id
    return _t(spark, sf).dim.select("id", name_from_id("id").alias("name"),
                                    class_from_id("id").alias("fallback_class"))


@register("d5_search")
def d5(spark, sf):
    return D.search(profile(_t(spark, sf)), SEARCH_TEXT).select("id", "name", "student_class")


@register("d5_search_literal_percent")
def d5b(spark, sf):
    return D.search(profile(_t(spark, sf)), "%").select("id", "name")


@register("d6_segment_anomaly")
def d6a(spark, sf):
    return D.filter_segment(profile(_t(spark, sf)), "anomaly").select("id", "risk_score")


@register("d6_segment_fee_risk")
def d6b(spark, sf):
    return D.filter_segment(profile(_t(spark, sf)), "fee_risk").select("id", "fee_prob")


@register("d6_segment_safe")
def d6c(spark, sf):
    return D.filter_segment(profile(_t(spark, sf)), "safe").select("id", "risk_score", "fee_label")


@register("d7_sort_profiles")
def d7(spark, sf):
    return D.sort_profiles(profile(_t(spark, sf)), "att_asc").select("id", "attendance_rate")


def _sorted_by(key, col):
    @register(f"d7_sort_{key}")
    def by_key(spark, sf):
        return D.sort_profiles(profile(_t(spark, sf)), key).select("id", col)


for _key, _col in (("risk_desc", "risk_score"), ("risk_asc", "risk_score"), ("att_desc", "attendance_rate"), ("fee_desc", "fee_prob")):
    _sorted_by(_key, _col)


@register("d8_page")
def d8(spark, sf):
    return D.page(profile(_t(spark, sf)), PAGE_NUMBER, "risk_desc").select("id", "name", "risk_score")


@register("d8_keyset_page")
def d8k(spark, sf):
    """The page after the last row of the page before it, without an offset."""
    prof = profile(_t(spark, sf))
    last = D.page(prof, PAGE_NUMBER - 1, "risk_desc").select("risk_score", "id").collect()[-1]
    return D.keyset_page(prof, "risk_desc", (last["risk_score"], last["id"])).select("id", "name", "risk_score")


@register("d8_keyset_page_by_id")
def d8ki(spark, sf):
    return D.keyset_page(profile(_t(spark, sf)), None, (None, 40)).select("id", "name")


@register("d8_page_info")
def d8i(spark, sf):
    return D.page_info(D.filter_segment(profile(_t(spark, sf)), "safe"), PAGE_NUMBER)


@register("d9_lookup")
def d9(spark, sf):
    return D.lookup(profile(_t(spark, sf)), LOOKUP_ID)


@register("d10_history")
def d10(spark, sf):
    return D.history(_t(spark, sf).presence, LOOKUP_ID, n=RECENT_N_TEST)


@register("d10_history_arrays")
def d10s(spark, sf):
    h = D.history_arrays(_t(spark, sf).presence, n=RECENT_N_TEST)
    return h.select("id", F.array_join(F.transform("history", lambda x: F.concat(
        x["date"].cast("string"), F.lit(":"), x["is_present"].cast("string"))), ",").alias("history"))


@register("d11_score_ids_anomaly")
def d11(spark, sf):
    t = _t(spark, sf)
    scored = D.surrogate_anomaly_scores(presence_feats(t))
    return D.anomaly_results(D.score_ids(scored, request_ids(t)))


@register("d12_score_ids_fee")
def d12(spark, sf):
    t = _t(spark, sf)
    scored = D.surrogate_fee_scores(fee_feats(t))
    return D.fee_results(D.score_ids(scored, request_ids(t)))


@register("d13_overall_status")
def d13(spark, sf):
    return D.with_display(profile(_t(spark, sf))).select("id", "overall_status")


@register("d14_bands")
def d14(spark, sf):
    return D.with_display(profile(_t(spark, sf))).select("id", "attendance_band", "risk_band", "prob_band")


@register("d15_risk_reasons")
def d15(spark, sf):
    r = D.risk_reasons(profile(_t(spark, sf)))
    return r.select("id", F.array_join("attendance_reasons", " | ").alias("attendance_reasons"),
                    F.array_join("fee_reasons", " | ").alias("fee_reasons"), "no_risk")


@register("d16_initials")
def d16(spark, sf):
    return D.with_display(profile(_t(spark, sf))).select("id", "initials")


@register("d17_decode_status")
def d17(spark, sf):
    return D.with_display(profile(_t(spark, sf))).select("id", "fee_status")


# ---------------------------------------------------------------- B: dashboard
@register("b1_summary")
def b1(spark, sf):
    return B.summary(profile(_t(spark, sf)))


@register("b2_risk_distribution")
def b2(spark, sf):
    return B.risk_distribution(profile(_t(spark, sf)))


@register("b3_fee_distribution")
def b3(spark, sf):
    return B.fee_distribution(profile(_t(spark, sf)))


@register("b4_rate_histogram")
def b4(spark, sf):
    return B.rate_histogram(profile(_t(spark, sf)))


@register("b5_class_breakdown")
def b5(spark, sf):
    return B.class_breakdown(profile(_t(spark, sf)))


@register("b6_combined_risk_ranking")
def b6(spark, sf):
    return B.combined_risk_ranking(profile(_t(spark, sf))).select("id", "name", "combined_risk")


@register("b7_top_n")
def b7(spark, sf):
    return B.top_n(profile(_t(spark, sf)), 10).select("id", "name", "student_class", "combined_risk")


@register("b8_alert_feed")
def b8(spark, sf):
    return B.alert_feed(profile(_t(spark, sf)))


@register("b9_health_score")
def b9(spark, sf):
    return B.health_score(profile(_t(spark, sf)))


@register("b10_safe_count_landing")
def b10(spark, sf):
    return B.safe_count_landing(profile(_t(spark, sf)))


@register("b11_drill_down_risk_tier")
def b11a(spark, sf):
    return B.drill_down(profile(_t(spark, sf)), "risk_tier", "Medium").select("id", "risk_score")


@register("b11_drill_down_rate_bucket")
def b11b(spark, sf):
    return B.drill_down(profile(_t(spark, sf)), "rate_bucket", "80-90%").select("id", "attendance_rate")


@register("b11_drill_down_class")
def b11c(spark, sf):
    return B.drill_down(profile(_t(spark, sf)), "class", "GERMANY", "defaults").select("id", "fee_label")


@register("b11_drill_down_fee_status")
def b11d(spark, sf):
    return B.drill_down(profile(_t(spark, sf)), "fee_status", "Late").select("id", "fee_label")


@register("b11_drill_down_class_metrics")
def b11e(spark, sf):
    """A class that has rows, under every metric."""
    prof = profile(_t(spark, sf))
    top = prof.groupBy("student_class").count().orderBy(F.desc("count"), "student_class").first()["student_class"]
    parts = [B.drill_down(prof, "class", top, m).select("id", F.lit(m).alias("metric")) for m in ("all", "anomalies", "late", "defaults")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@register("b12_suggest")
def b12(spark, sf):
    return B.suggest(profile(_t(spark, sf)), SEARCH_TEXT, 5)


@register("b13_kpis")
def b13(spark, sf):
    return B.kpis(profile(_t(spark, sf)))


@register("b13_analytics_bundle")
def b13all(spark, sf):
    """Every part of the dashboard as (part, key, metric, value) rows."""
    return B.analytics_bundle(profile(_t(spark, sf)))


@register("b14_status_counts")
def b14(spark, sf):
    return B.status_counts(_t(spark, sf).periods)


@register("s5_write_read_features")
def s5(spark, sf):
    """S5 then S4: write the labelled presence features as CSV (integral columns as doubles, like the
    reference's stored tables) into the shared checkpoint folder, read them back with the schema'd
    reader and its float->int casts."""
    import uuid
    from vigilo.session import ensure_checkpoint_dir
    from vigilo.sources.readers import read_features, write_features
    t = _t(spark, sf)
    f = att_table(t)
    stored = f.select(F.col("student_id").cast("string").alias("student_id"), "attendance_rate",
                      *[F.col(c).cast("double").alias(c) for c in ("longest_absence_streak", "absence_in_last_30_days")],
                      "day_of_week_variance", F.col("is_anomaly").cast("double").alias("is_anomaly"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/features-{uuid.uuid4().hex}/presence.csv"
    write_features(stored, path, fmt="csv")
    back = read_features(spark, path, "presence", fmt="csv")
    return back.select("student_id", r6("attendance_rate").alias("attendance_rate"), "longest_absence_streak",
                       "absence_in_last_30_days", r6("day_of_week_variance").alias("day_of_week_variance"),
                       "is_anomaly")


@register("s4_read_period_features")
def s4p(spark, sf):
    """S4 of the period kind: the fee features stored as CSV (all numbers as doubles), read back with schema and casts."""
    import uuid
    from vigilo.session import ensure_checkpoint_dir
    from vigilo.sources.readers import read_features, write_features
    f = fee_table(_t(spark, sf))
    stored = f.select(F.col("student_id").cast("string").alias("student_id"), *[F.col(c).cast("double").alias(c) for c in f.columns[1:]])
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/features-{uuid.uuid4().hex}/period.csv"
    write_features(stored, path, fmt="csv")
    return read_features(spark, path, "period", fmt="csv")


@register("d6_list_students")
def d6l(spark, sf):
    return D.list_students(profile(_t(spark, sf)), SEARCH_TEXT, "safe").select("id", "name", "fee_label")


@register("d9_entity_detail")
def d9d(spark, sf):
    t = _t(spark, sf)
    d = D.entity_detail(profile(t), t.presence, LOOKUP_ID, n=RECENT_N_TEST)
    return d.select("id", "name", "risk_score", F.array_join(F.transform("history", lambda x: F.concat(
        x["date"].cast("string"), F.lit(":"), x["is_present"].cast("string"))), ",").alias("history"))
