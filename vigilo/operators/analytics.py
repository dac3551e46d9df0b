"""Dashboard analytics over the scored profile.

Counts that share one scan are fused into ONE conditional aggregation
(partial aggregation per task, a single tiny merge), then reshaped with
``stack``/``inline`` — no re-scan per chart, no join against a bucket table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.functions import rint_round, risk_tier

# Fixed values of the reference: histogram buckets (label, lower bound inclusive).
RATE_BUCKETS = [("0-50%", None), ("50-60%", 50.0), ("60-70%", 60.0), ("70-80%", 70.0),
                ("80-90%", 80.0), ("90-100%", 90.0)]
TOP_N_CHOICES = (10, 20, 30, 50, None)  # None = all


def _cnt(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def _health(total: str, high: str, defaults: str) -> F.Column:
    return F.greatest(F.lit(0.0), rint_round(F.lit(100.0) - F.col(high) / F.col(total) * F.lit(40.0)
                                             - F.col(defaults) / F.col(total) * F.lit(60.0), 1))


def kpis(profile: DataFrame) -> DataFrame:
    """B1 + B2 + B3 + B9 + B10 fused: every dashboard counter from one scan (B13 core)."""
    r, fl = F.col("risk_score"), F.col("fee_label")
    agg = profile.agg(
        F.count(F.lit(1)).alias("total"),
        _cnt(F.col("is_anomaly")).alias("anomalies"),
        _cnt(fl == 2).alias("fee_defaults"),
        _cnt(fl == 1).alias("fee_late"),
        _cnt(fl == 0).alias("fee_on_time"),
        _cnt(r > 70).alias("risk_high"),
        _cnt((r > 40) & (r <= 70)).alias("risk_medium"),
    )
    return agg.select(
        "*",
        (F.col("total") - F.col("risk_high") - F.col("risk_medium")).alias("risk_low"),
        F.when(F.col("total") > 0, _health("total", "risk_high", "fee_defaults")).alias("system_health"),
        F.greatest(F.lit(0), F.col("total") - F.col("anomalies") - F.col("fee_defaults")).alias("landing_safe"),
    )


def summary(profile: DataFrame) -> DataFrame:
    """B1: total, anomalies, defaults, late."""
    return kpis(profile).select("total", "anomalies", "fee_defaults", "fee_late")


def risk_distribution(profile: DataFrame) -> DataFrame:
    """B2: High (> 70) / Medium (> 40) / Low (rest) on the rounded risk, all three rows."""
    return kpis(profile).selectExpr(
        "stack(3, 'High', risk_high, 'Medium', risk_medium, 'Low', risk_low) as (tier, students)")


def fee_distribution(profile: DataFrame) -> DataFrame:
    """On Time / Late / Default counts, all three rows."""
    return kpis(profile).selectExpr(
        "stack(3, 'On Time', fee_on_time, 'Late', fee_late, 'Default', fee_defaults) as (status, students)")


def rate_histogram(profile: DataFrame) -> DataFrame:
    """Six fixed buckets of the rounded attendance %, empty buckets kept."""
    r = F.col("attendance_rate")
    bounds = [lo for _, lo in RATE_BUCKETS[1:]] + [None]
    cols = []
    for i, (label, lo) in enumerate(RATE_BUCKETS):
        hi = bounds[i]
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (r >= lo)
        if hi is not None:
            cond = cond & (r < hi)
        cols.append(_cnt(cond).alias(f"b{i}"))
    agg = profile.agg(*cols)
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(label).alias("bucket"),
                              F.col(f"b{i}").alias("students"))
                     for i, (label, _) in enumerate(RATE_BUCKETS)])
    return agg.select(F.inline(rows))


def class_breakdown(profile: DataFrame) -> DataFrame:
    """Per class total, anomalies, defaults, late; classes sorted as strings."""
    fl = F.col("fee_label")
    return (profile.groupBy(F.coalesce(F.col("student_class"), F.lit("Unknown")).alias("class"))
            .agg(F.count(F.lit(1)).alias("total"), _cnt(F.col("is_anomaly")).alias("anomalies"),
                 _cnt(fl == 2).alias("defaults"), _cnt(fl == 1).alias("late"))
            .orderBy("class"))


def combined_risk(profile: DataFrame) -> DataFrame:
    """B6 score column: 0.5 * risk + 0.5 * default probability %."""
    return profile.select(
        "id", "name", "student_class", "attendance_rate", "risk_score", "fee_prob", "is_anomaly",
        "fee_label",
        (F.col("risk_score") * F.lit(0.5) + F.col("fee_prob") * F.lit(0.5)).alias("combined_risk"))


def combined_risk_ranking(profile: DataFrame) -> DataFrame:
    """Descending combined score, ties in id order (stable)."""
    return combined_risk(profile).orderBy(F.desc("combined_risk"), F.asc("id"))


def top_n(profile: DataFrame, n: int | None = 10) -> DataFrame:
    """Head of B6 (a bounded TakeOrderedAndProject); None = all."""
    ranked = combined_risk_ranking(profile)
    return ranked if n is None else ranked.limit(n)


def alert_feed(profile: DataFrame, n: int = 8) -> DataFrame:
    """First ``n`` flagged entities in table (id) order; anomaly wins over default."""
    a = F.col("is_anomaly")
    return (profile.filter(a | (F.col("fee_label") == 2))
            .orderBy("id").limit(n)
            .select("id", "name",
                    F.when(a, "Attendance Anomaly").otherwise("Fee Default").alias("type"),
                    F.when(a, F.concat(F.lit("Risk "), F.col("risk_score").cast("string")))
                     .otherwise(F.concat(F.col("fee_prob").cast("string"), F.lit("% default prob")))
                     .alias("detail")))


def health_score(profile: DataFrame) -> DataFrame:
    """max(0, round(100 - 40 high/total - 60 defaults/total, 1)); empty profile -> no row."""
    return kpis(profile).filter(F.col("total") > 0).select("system_health")


def safe_count_landing(profile: DataFrame) -> DataFrame:
    """Landing-page "safe" = max(0, total - anomalies - defaults) (overlap counted twice)."""
    return kpis(profile).select("landing_safe")


def rate_bucket(col="attendance_rate") -> F.Column:
    """Bucket label of B4 for one row (used by drill-down)."""
    r = F.col(col)
    expr = F.when(r < 50, RATE_BUCKETS[0][0])
    for (label, lo), nxt in zip(RATE_BUCKETS[1:-1], RATE_BUCKETS[2:]):
        expr = expr.when(r < nxt[1], label)
    return expr.otherwise(RATE_BUCKETS[-1][0])


def drill_down(profile: DataFrame, kind: str, value: str, metric: str | None = None) -> DataFrame:
    """The entities behind one chart segment.

    kind: 'risk_tier' (High/Medium/Low), 'fee_status' (On Time/Late/Default),
    'rate_bucket' (B4 label), 'class' (with metric all/anomalies/defaults/late).
    """
    if kind == "risk_tier":
        return profile.filter(risk_tier("risk_score") == value)
    if kind == "fee_status":
        code = {"On Time": 0, "Late": 1, "Default": 2}[value]
        return profile.filter(F.col("fee_label") == code)
    if kind == "rate_bucket":
        return profile.filter(rate_bucket() == value)
    if kind == "class":
        df = profile.filter(F.coalesce("student_class", F.lit("Unknown")) == value)
        if metric == "anomalies":
            df = df.filter(F.col("is_anomaly"))
        elif metric == "defaults":
            df = df.filter(F.col("fee_label") == 2)
        elif metric == "late":
            df = df.filter(F.col("fee_label") == 1)
        return df
    raise ValueError(f"unknown drill-down kind {kind!r}")


def suggest(profile: DataFrame, text: str, n: int = 5) -> DataFrame:
    """First ``n`` entities (id order) whose name or id contains the typed text."""
    from vigilo.operators.profile import search
    return search(profile, text).orderBy("id").limit(n).select("id", "name", "student_class")


# Fixed values of the reference: names of the bundle's parts and of the fields of its listed entities.
BUNDLE_PARTS = ("totals", "risk_distribution", "fee_distribution", "attendance_histogram", "class_breakdown",
                "top_risk_students", "recent_activity", "system_health")
TOTAL_FIELDS = {"total_students": "total", "anomaly_count": "anomalies", "fee_default_count": "fee_defaults", "fee_late_count": "fee_late"}
TOP_FIELDS = ("id", "name", "student_class", "attendance_rate", "risk_score", "fee_prob", "is_anomaly", "fee_label")
ACTIVITY_FIELDS = ("id", "name", "type", "detail")
ACTIVITY_ROWS = 8


def _first_k(order: list[F.Column], fields: tuple, k: int, where=None) -> F.Column:
    """Aggregate: the first ``k`` rows by ``order`` as structs; a mergeable state of at most ``k`` rows per group and task."""
    from pyspark.sql.internal import InternalFunction
    row = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*[F.col(c) for c in fields]).alias("row"))
    return InternalFunction.collect_top_k(row if where is None else F.when(where, row), k, True)


def analytics_bundle(profile: DataFrame, top: int = 10) -> DataFrame:
    """Every dashboard part as rows ``(part, key, metric, value)`` from ONE scan of the profile, nothing cached.

    A single aggregation over the grouping sets (class) and () carries all
    counters and two bounded top-k states (the ``top`` riskiest entities, the
    first ACTIVITY_ROWS flagged ones), so a task ships one row per class, never
    its entities. Listed entities are keyed by their rank (from 1). Values are
    text, as the parts differ in type. An empty profile gives no rows.
    """
    if top is None or top < 1:
        raise ValueError("the bundle lists a bounded number of entities: use combined_risk_ranking for all")
    fl, r, flagged = F.col("fee_label"), F.col("risk_score"), F.col("is_anomaly")
    p = profile.select(
        *TOP_FIELDS, F.coalesce("student_class", F.lit("Unknown")).alias("class"), rate_bucket().alias("bucket"),
        (r * F.lit(0.5) + F.col("fee_prob") * F.lit(0.5)).alias("combined"),
        F.when(flagged, "Attendance Anomaly").otherwise("Fee Default").alias("type"),
        F.when(flagged, F.concat(F.lit("Risk "), r.cast("string")))
         .otherwise(F.concat(F.col("fee_prob").cast("string"), F.lit("% default prob"))).alias("detail"))
    whole = p.rollup("class").agg(
        F.grouping_id().alias("all"),
        F.count(F.lit(1)).alias("total"), _cnt(flagged).alias("anomalies"),
        _cnt(fl == 2).alias("fee_defaults"), _cnt(fl == 1).alias("fee_late"), _cnt(fl == 0).alias("fee_on_time"),
        _cnt(r > 70).alias("risk_high"), _cnt((r > 40) & (r <= 70)).alias("risk_medium"),
        *[_cnt(F.col("bucket") == label).alias(f"b{i}") for i, (label, _) in enumerate(RATE_BUCKETS)],
        _first_k([-F.col("combined"), F.col("id")], TOP_FIELDS, top).alias("riskiest"),
        _first_k([F.col("id")], ACTIVITY_FIELDS, ACTIVITY_ROWS, flagged | (fl == 2)).alias("activity"))

    def rows(part: str, key, metrics: dict) -> list[F.Column]:
        return [F.struct(F.lit(part).alias("part"), key.cast("string").alias("key"), F.lit(m).alias("metric"),
                         v.cast("string").alias("value")) for m, v in metrics.items()]

    def listed(part: str, col: str, fields: tuple) -> F.Column:
        return F.flatten(F.transform(col, lambda x, i: F.array(*rows(part, i + 1, {c: x["row"][c] for c in fields}))))

    totals, risks, fees, histogram, classes, riskiest, activity, health = BUNDLE_PARTS
    n = F.col
    low = n("total") - n("risk_high") - n("risk_medium")
    fixed = rows(totals, F.lit("all"), {k: n(c) for k, c in TOTAL_FIELDS.items()})
    for key, value in (("High", n("risk_high")), ("Medium", n("risk_medium")), ("Low", low)):
        fixed += rows(risks, F.lit(key), {"count": value})
    for key, value in (("On Time", n("fee_on_time")), ("Late", n("fee_late")), ("Default", n("fee_defaults"))):
        fixed += rows(fees, F.lit(key), {"count": value})
    for i, (label, _) in enumerate(RATE_BUCKETS):
        fixed += rows(histogram, F.lit(label), {"count": n(f"b{i}")})
    fixed += rows(health, F.lit("all"), {health: _health("total", "risk_high", "fee_defaults")})
    of_class = rows(classes, n("class"), {"total": n("total"), "anomalies": n("anomalies"), "defaults": n("fee_defaults"), "late": n("fee_late")})
    every = F.concat(F.array(*fixed), listed(riskiest, "riskiest", TOP_FIELDS), listed(activity, "activity", ACTIVITY_FIELDS))
    return whole.select(F.inline(F.when(n("all") == 1, every).otherwise(F.array(*of_class))))


def status_counts(periods: DataFrame, status_col: str = "status") -> DataFrame:
    """Raw period status value counts, sorted by status."""
    return periods.groupBy(status_col).agg(F.count(F.lit(1)).alias("periods")).orderBy(status_col)
