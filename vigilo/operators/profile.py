"""The scored profile table and directory queries over it.

The profile is one row per presence entity, built with left joins (missing
payment scores default to 0) — never a driver-side dict. Directory queries
are filters/sorts/limits over it, so the driver only ever receives a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilo.functions import (
    rint_round, clip, risk_tier, fee_tier, overall_status, attendance_band, risk_band,
    prob_band, decode_status, initials, contains_literal, name_from_id, class_from_id,
)

PAGE_SIZE = 20
PROFILE_COLUMNS = ["id", "name", "student_class", "attendance_rate", "is_anomaly", "risk_score",
                   "absence_streak", "absence_30d", "fee_label", "fee_prob", "outstanding", "days_late"]


def risk_from_decision(decision: Column) -> Column:
    """M5: risk = clip(100 * (1 - (d + 0.5)), 0, 100) = clip(50 - 100 d)."""
    return clip(F.lit(100.0) * (F.lit(1.0) - (decision + F.lit(0.5))), 0.0, 100.0)


def surrogate_anomaly_scores(features: DataFrame, id_col: str = "id") -> DataFrame:
    """Deterministic stand-in for the anomaly model (tests/oracle only).

    risk_raw = clip(50 - 200 (rate - 0.85)); flag = risk_raw > 50.
    """
    risk = clip(F.lit(50.0) - F.lit(200.0) * (F.col("attendance_rate") - F.lit(0.85)), 0.0, 100.0)
    return features.select("*", risk.alias("risk_raw"), (risk > 50).alias("is_anomaly_pred"))


def surrogate_fee_scores(fee_features: DataFrame) -> DataFrame:
    """Deterministic stand-in for the default model (tests/oracle only).

    p(default) = min(1, 0.2 * previous status + days / 1500); label = actual label.
    """
    p = F.least(F.lit(1.0), F.lit(0.2) * F.col("previous_term_status")
                + F.col("days_since_last_payment") / F.lit(1500.0))
    return fee_features.select("*", p.alias("default_prob"), F.col("label").alias("label_pred"))


def build_profile(att_scored: DataFrame, fee_scored: DataFrame | None, dim: DataFrame | None = None,
                  id_col: str = "id") -> DataFrame:
    """D3: join presence scores, payment scores and the class dimension into the profile.

    ``att_scored``: id, attendance_rate, longest_absence_streak,
    absence_in_last_30_days, risk_raw, is_anomaly_pred.
    ``fee_scored``: id, default_prob, label_pred, total_outstanding,
    days_since_last_payment. Missing payment row -> prob 0, label 0,
    outstanding 0, days 0. Missing class -> class picked from the id.
    """
    a = att_scored.select(id_col, "attendance_rate", "longest_absence_streak", "absence_in_last_30_days",
                          "risk_raw", "is_anomaly_pred")
    if fee_scored is not None:
        f = fee_scored.select(id_col, "default_prob", "label_pred", "total_outstanding",
                              "days_since_last_payment")
        a = a.join(f, id_col, "left")
    else:
        a = (a.withColumn("default_prob", F.lit(None).cast("double"))
              .withColumn("label_pred", F.lit(None).cast("int"))
              .withColumn("total_outstanding", F.lit(None).cast("double"))
              .withColumn("days_since_last_payment", F.lit(None).cast("double")))
    if dim is not None:
        a = a.join(dim.select(id_col, F.col("class").alias("_class")), id_col, "left")
    else:
        a = a.withColumn("_class", F.lit(None).cast("string"))
    return a.select(
        F.col(id_col).alias("id"),
        name_from_id(id_col).alias("name"),
        F.coalesce(F.col("_class"), class_from_id(id_col)).alias("student_class"),
        rint_round(F.col("attendance_rate") * F.lit(100.0), 1).alias("attendance_rate"),
        F.col("is_anomaly_pred").alias("is_anomaly"),
        rint_round(F.col("risk_raw"), 1).alias("risk_score"),
        F.col("longest_absence_streak").cast("int").alias("absence_streak"),
        F.col("absence_in_last_30_days").cast("int").alias("absence_30d"),
        F.coalesce(F.col("label_pred").cast("int"), F.lit(0)).alias("fee_label"),
        F.coalesce(rint_round(F.lit(100.0) * F.col("default_prob"), 1), F.lit(0.0)).alias("fee_prob"),
        F.coalesce(F.col("total_outstanding"), F.lit(0.0)).alias("outstanding"),
        F.coalesce(F.col("days_since_last_payment").cast("int"), F.lit(0)).alias("days_late"),
    )


def with_tiers(profile: DataFrame) -> DataFrame:
    """D1/D2 on the profile's rounded values (dashboard form)."""
    return profile.select("id", risk_tier("risk_score").alias("risk_tier"),
                          fee_tier(F.col("fee_prob") / F.lit(100.0)).alias("fee_tier"),
                          fee_tier(F.col("fee_prob") / F.lit(100.0), inclusive=True).alias("fee_tier_batch"))


def search(profile: DataFrame, q: str) -> DataFrame:
    """Case-insensitive literal substring on name or id; empty text = no filter."""
    if not q:
        return profile
    return profile.filter(contains_literal("name", q) | contains_literal("id", q))


SEGMENTS = ("all", "anomaly", "fee_risk", "safe")


def filter_segment(profile: DataFrame, segment: str) -> DataFrame:
    """All / anomaly / fee_risk / safe (= not anomaly and on time); unknown -> no filter."""
    if segment == "anomaly":
        return profile.filter(F.col("is_anomaly"))
    if segment == "fee_risk":
        return profile.filter(F.col("fee_label") == 2)
    if segment == "safe":
        return profile.filter(~F.col("is_anomaly") & (F.col("fee_label") == 0))
    return profile


# sort key -> (column, descending)
SORT_KEYS = {
    "risk_desc": ("risk_score", True),
    "risk_asc": ("risk_score", False),
    "att_desc": ("attendance_rate", True),
    "att_asc": ("attendance_rate", False),
    "fee_desc": ("fee_prob", True),
}


def sort_order(key: str | None) -> list[Column]:
    """Sort columns for a key, always ending with id (stable order); none = id order."""
    if not key or key not in SORT_KEYS:
        return [F.asc("id")]
    col, desc = SORT_KEYS[key]
    return [F.desc(col) if desc else F.asc(col), F.asc("id")]


def sort_profiles(profile: DataFrame, key: str | None) -> DataFrame:
    """D7."""
    return profile.orderBy(*sort_order(key))


def page(df: DataFrame, number: int, key: str | None = None, size: int = PAGE_SIZE) -> DataFrame:
    """One page (1-based) under a sort key — a bounded top-(number*size) plan."""
    if number < 1:
        raise ValueError("page numbers start at 1")
    return df.orderBy(*sort_order(key)).offset((number - 1) * size).limit(size)


def page_info(df: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Total, page count and the "a–b of total" label for a page."""
    total = F.count(F.lit(1))
    return df.agg(total.alias("total")).select(
        "total",
        F.ceil(F.col("total") / F.lit(size)).cast("long").alias("pages"),
        F.format_string("%d–%d of %d", F.lit((number - 1) * size + 1),
                        F.least(F.lit(number * size).cast("long"), F.col("total")), F.col("total")).alias("label"))


def keyset_page(df: DataFrame, key: str | None, after: tuple | None, size: int = PAGE_SIZE) -> DataFrame:
    """D8 for deep pages: rows strictly after the (sort value, id) of the last row seen.

    Unlike offset paging, the cost does not grow with the page number. Without a
    key the order is by id and the sort value is not looked at.
    """
    if after is not None and key not in SORT_KEYS:
        df = df.filter(F.col("id") > after[1])
    elif after is not None:
        col, desc = SORT_KEYS[key]
        v, last_id = after
        beyond = (F.col(col) < v) if desc else (F.col(col) > v)
        df = df.filter(beyond | ((F.col(col) == v) & (F.col("id") > last_id)))
    return df.orderBy(*sort_order(key)).limit(size)


def lookup(profile: DataFrame, entity_id) -> DataFrame:
    """Exact id; unknown -> empty."""
    return profile.filter(F.col("id") == F.lit(entity_id))


def history(presence: DataFrame, entity_id, n: int = 30, id_col: str = "id",
            date_col: str = "date") -> DataFrame:
    """The last ``n`` presence rows of one entity in ascending date order.

    The id filter is pushed to the scan; the limit is a bounded top-n.
    """
    last = (presence.filter(F.col(id_col) == F.lit(entity_id))
            .orderBy(F.desc(date_col)).limit(n))
    return last.orderBy(date_col)


def history_arrays(presence: DataFrame, n: int = 30, id_col: str = "id", date_col: str = "date",
                   flag_col: str = "is_present") -> DataFrame:
    """D10 set form: every entity's last ``n`` rows as an ascending array of (date, flag).

    Each array holds at most n elements (bounded group), built after a
    per-entity group limit.
    """
    w = Window.partitionBy(id_col).orderBy(F.desc(date_col))
    last = presence.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    return (last.groupBy(id_col)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(date_col).alias("date"),
                                                      F.col(flag_col).alias("is_present")))).alias("history")))


def score_ids(table: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """D11/D12 request step: semi-join — table order, unknown ids dropped, duplicates ignored."""
    return table.join(ids.select(F.col(ids.columns[0]).alias(id_col)).distinct(), id_col, "left_semi")


def anomaly_results(scored: DataFrame) -> DataFrame:
    """D11 result: id, risk 2 dp, flag, tier on the unrounded risk."""
    return scored.select(F.col("id").alias("student_id"),
                         rint_round(F.col("risk_raw"), 2).alias("risk_score"),
                         F.col("is_anomaly_pred").alias("is_flagged"),
                         risk_tier("risk_raw").alias("risk_level"))


def fee_results(scored: DataFrame) -> DataFrame:
    """D12 result: id, class-2 probability (2 dp fraction), strict tier on the unrounded value."""
    return scored.select(F.col("id").alias("student_id"),
                         rint_round(F.col("default_prob"), 2).alias("default_probability"),
                         fee_tier("default_prob").alias("risk_category"))


def with_display(profile: DataFrame) -> DataFrame:
    """Overall status, colour bands, initials, decoded status."""
    return profile.select(
        "id",
        overall_status("is_anomaly", "fee_label", "risk_score").alias("overall_status"),
        attendance_band("attendance_rate").alias("attendance_band"),
        risk_band("risk_score").alias("risk_band"),
        prob_band("fee_prob").alias("prob_band"),
        initials("name").alias("initials"),
        decode_status("fee_label").alias("fee_status"),
    )


def _num(c: str) -> Column:
    """A number as the page prints it: no trailing zeros, no exponent."""
    return F.regexp_replace(F.format_string("%.6f", F.col(c).cast("double")), r"\.?0+$", "")


def _money(c: str) -> Column:
    """Thousands groups, at most three decimals, no trailing zeros."""
    return F.regexp_replace(F.format_number(F.col(c).cast("double"), 3), r"\.?0+$", "")


def risk_reasons(profile: DataFrame) -> DataFrame:
    """Attendance and payment reason lists; both empty -> a single "no risk" note.

    The thresholds and wording are fixed values of the reference.
    """
    a = F.col("is_anomaly")
    rate = F.col("attendance_rate")
    att = F.array_compact(F.array(
        F.when(a & (rate < 50), F.concat(F.lit("Critical attendance at "), _num("attendance_rate"),
                                         F.lit("% — far below the 75% safe threshold. IsolationForest flagged this as a severe anomaly.")))
         .when(a & (rate < 70), F.concat(F.lit("Attendance dropped to "), _num("attendance_rate"),
                                         F.lit("%, triggering the anomaly detection model.")))
         .when(a, F.concat(F.lit("Despite "), _num("attendance_rate"),
                           F.lit("% overall, the absence pattern is irregular — a sudden recent drop was detected."))),
        F.when(a & (F.col("absence_streak") >= 5),
               F.concat(_num("absence_streak"), F.lit("-day consecutive absence streak detected — possible family crisis or health issue."))),
        F.when(a & (F.col("absence_30d") >= 8),
               F.concat(_num("absence_30d"), F.lit(" absences in the last 30 days — sharp recent deterioration."))),
    ))
    fl = F.col("fee_label")
    fee = F.array_compact(F.array(
        F.when(fl == 2, F.concat(F.lit("Student has defaulted with ₹"), _money("outstanding"), F.lit(" outstanding.")))
         .when(fl == 1, F.concat(F.lit("Late payment pattern — "), _num("days_late"), F.lit(" days since last payment."))),
        F.when((fl == 2) & (F.col("days_late") > 30),
               F.concat(F.lit("Payment is "), _num("days_late"), F.lit(" days overdue — confirmed default."))),
        F.when((F.col("fee_prob") > 15) & (fl < 2),
               F.concat(F.lit("AI predicts "), _num("fee_prob"), F.lit("% chance of future default — early intervention recommended."))),
    ))
    return profile.select("id", att.alias("attendance_reasons"), fee.alias("fee_reasons"),
                          ((F.size(att) == 0) & (F.size(fee) == 0)).alias("no_risk"))


def list_students(profile: DataFrame, q: str = "", segment: str = "all") -> DataFrame:
    """D5 + D6 as one directory call: literal search, then segment filter (table order kept by id)."""
    return filter_segment(search(profile, q), segment)


def entity_detail(profile: DataFrame, presence: DataFrame, entity_id, n: int = 30,
                  id_col: str = "id", date_col: str = "date", flag_col: str = "is_present") -> DataFrame:
    """D9 + D10 nested: the entity's profile row with its last ``n`` presence rows as an ascending array.

    Both sides are filtered on the id before anything else (pushed to the
    scans); unknown id -> no row.
    """
    row = lookup(profile, entity_id)
    hist = (history(presence, entity_id, n, id_col, date_col)
            .groupBy(F.col(id_col).alias("id"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col(date_col).alias("date"),
                                                      F.col(flag_col).alias("is_present")))).alias("history")))
    return row.join(hist, "id", "left").withColumn(
        "history", F.coalesce(F.col("history"), F.array().cast("array<struct<date:date,is_present:int>>")))
