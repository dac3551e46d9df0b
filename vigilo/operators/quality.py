"""Q1–Q8: data-quality checks on the feature tables.

Every check of one table is computed from ONE aggregation over it (nulls,
mins, maxes and per-label means all in the same pass) and then reshaped into
check rows ``(tbl, check_name, col, observed, bound, severity, passed)``.
``error`` checks decide the gate; ``warn`` checks are reported only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK_SCHEMA = "tbl string, check_name string, col string, observed double, bound double, severity string, passed boolean"

# Fixed values of the reference: required columns and allowed ranges.
PRESENCE_REQUIRED = ["student_id", "attendance_rate", "longest_absence_streak",
                     "absence_in_last_30_days", "day_of_week_variance", "is_anomaly"]
PERIOD_REQUIRED = ["student_id", "days_since_last_payment", "previous_term_status",
                   "total_outstanding", "income_encoded", "transport_user", "sibling_count", "label"]
PRESENCE_RANGES = {"attendance_rate": (0.0, 1.0), "longest_absence_streak": (None, 200.0)}
PERIOD_RANGES = {"income_encoded": (0.0, 2.0), "transport_user": (0.0, 1.0), "sibling_count": (0.0, 3.0),
                 "previous_term_status": (0.0, 2.0), "label": (0.0, 2.0)}
ANOMALY_BAND_PCT = (10.0, 20.0)


@dataclass(frozen=True)
class MeanCheck:
    """Mean of ``col`` over label ``a`` compared with label ``b`` (``a_less``: mean_a < mean_b)."""
    col: str
    a: int
    b: int
    a_less: bool
    severity: str = "error"


# Q5 checks of the reference.
PRESENCE_MEAN_CHECKS = [MeanCheck("attendance_rate", 1, 0, True), MeanCheck("longest_absence_streak", 1, 0, False)]
PERIOD_MEAN_CHECKS = [MeanCheck("total_outstanding", 2, 0, False),
                      MeanCheck("income_encoded", 2, 0, False, "warn")]


def _row(tbl, check, col, observed: Column, bound: Column, severity, passed: Column) -> Column:
    return F.struct(F.lit(tbl).alias("tbl"), F.lit(check).alias("check_name"),
                    F.lit(col).cast("string").alias("col"), observed.cast("double").alias("observed"),
                    bound.cast("double").alias("bound"), F.lit(severity).alias("severity"),
                    F.coalesce(passed, F.lit(False)).alias("passed"))


def required_columns_rows(df: DataFrame, tbl: str, required: list[str]) -> list[Column]:
    """Q1 (metadata only): number of missing required columns."""
    missing = len(set(required) - set(df.columns))
    return [_row(tbl, "required_columns", None, F.lit(missing), F.lit(0), "error", F.lit(missing == 0))]


def _is_missing(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


#: The groups of checks ``feature_checks`` can build.
KINDS = ("required", "nulls", "ranges", "band", "means", "monotone")


def feature_checks(df: DataFrame, tbl: str, label_col: str, required: list[str],
                   ranges: dict[str, tuple], mean_checks: list[MeanCheck],
                   positive_label: int | None = None, band_pct: tuple | None = None,
                   monotone_col: str | None = None, labels: tuple = (0, 1, 2),
                   kinds: tuple = KINDS) -> DataFrame:
    """Q1–Q6 for one feature table in one aggregation; returns check rows.

    Only the aggregates of the ``kinds`` asked for are computed (the required
    columns alone need no scan). A check on a column that the table lacks is a
    failed row without an observed value.
    """
    have = set(df.columns)
    aggs, rows = {}, []

    def agg(name: str, column) -> Column:
        aggs.setdefault(name, column.alias(name))
        return F.col(name)

    def check(name, col, needs, observed, bound, severity, passed):
        if have.issuperset(needs):
            rows.append(_row(tbl, name, col, observed(), bound() if callable(bound) else F.lit(bound), severity, passed()))
        else:
            rows.append(_row(tbl, name, col, F.lit(None), F.lit(None) if callable(bound) else F.lit(bound), severity, F.lit(False)))

    if "required" in kinds:
        rows += required_columns_rows(df, tbl, required)
    if "nulls" in kinds:
        for c in df.columns:
            n = agg(f"_null_{c}", F.count(F.when(_is_missing(df, c), F.lit(1))))
            rows.append(_row(tbl, "nulls", c, n, F.lit(0), "error", n == 0))
    if "ranges" in kinds:
        for c, (lo, hi) in ranges.items():
            if lo is not None:
                low = lambda c=c: agg(f"_min_{c}", F.min(c))
                check("min", c, {c}, low, lo, "error", lambda low=low, lo=lo: low() >= lo)
            if hi is not None:
                high = lambda c=c: agg(f"_max_{c}", F.max(c))
                check("max", c, {c}, high, hi, "error", lambda high=high, hi=hi: high() <= hi)
    if "band" in kinds and positive_label is not None and band_pct is not None:
        def pct():
            pos = agg("_pos", F.count(F.when(F.col(label_col) == positive_label, F.lit(1))))
            return F.try_divide(pos, agg("_n", F.count(F.lit(1)))) * F.lit(100.0)
        check("label_pct_min", label_col, {label_col}, pct, band_pct[0], "warn", lambda: pct() >= band_pct[0])
        check("label_pct_max", label_col, {label_col}, pct, band_pct[1], "warn", lambda: pct() <= band_pct[1])

    def mean(c, k):
        return agg(f"_mean_{c}_{k}", F.avg(F.when(F.col(label_col) == k, F.col(c))))

    if "means" in kinds:
        for m in mean_checks:
            a, b = (lambda m=m: mean(m.col, m.a)), (lambda m=m: mean(m.col, m.b))
            check(f"mean_{m.a}_{'lt' if m.a_less else 'gt'}_{m.b}", m.col, {m.col, label_col}, a, b, m.severity,
                  lambda m=m, a=a, b=b: (a() < b()) if m.a_less else (a() > b()))
    if "monotone" in kinds and monotone_col:
        for lo_k, hi_k in zip(labels, labels[1:]):
            a, b = (lambda k=hi_k: mean(monotone_col, k)), (lambda k=lo_k: mean(monotone_col, k))
            check(f"rising_{hi_k}_over_{lo_k}", monotone_col, {monotone_col, label_col}, a, b, "warn",
                  lambda a=a, b=b: a() > b())
    if not rows:
        return df.sparkSession.createDataFrame([], CHECK_SCHEMA)
    stats = df.agg(*aggs.values()) if aggs else df.sparkSession.range(1)
    return stats.select(F.inline(F.array(*rows)))


def presence_checks(df: DataFrame, tbl: str = "attendance_features", kinds: tuple = KINDS) -> DataFrame:
    """Q1–Q5 for the presence feature table (label ``is_anomaly``)."""
    return feature_checks(df, tbl, "is_anomaly", PRESENCE_REQUIRED, PRESENCE_RANGES,
                          PRESENCE_MEAN_CHECKS, positive_label=1, band_pct=ANOMALY_BAND_PCT, kinds=kinds)


def period_checks(df: DataFrame, tbl: str = "fee_features", kinds: tuple = KINDS) -> DataFrame:
    """Q1–Q6 for the period feature table (label 0/1/2)."""
    return feature_checks(df, tbl, "label", PERIOD_REQUIRED, PERIOD_RANGES, PERIOD_MEAN_CHECKS,
                          monotone_col="days_since_last_payment", kinds=kinds)


def label_distribution(df: DataFrame, label_col: str, tbl: str) -> DataFrame:
    """Q4 table: count and % per label value, sorted by label.

    The total comes from a window over the grouped counts (one row per label
    value — a bounded set), not from a second scan or a join.
    """
    from pyspark.sql import Window
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return (counts.select(F.lit(tbl).alias("tbl"), F.col(label_col).cast("int").alias("label"), "n",
                          (F.col("n") / total * F.lit(100.0)).alias("pct"))
            .orderBy("label"))


def sample_top_anomalies(df: DataFrame, n: int = 5, label_col: str = "is_anomaly",
                         streak_col: str = "longest_absence_streak", id_col: str = "student_id") -> DataFrame:
    """Q7: labelled anomalies with the longest streaks (id breaks ties)."""
    return df.filter(F.col(label_col) == 1).orderBy(F.desc(streak_col), F.asc(id_col)).limit(n)


def quality_gate(checks: DataFrame) -> DataFrame:
    """Q8: per table and overall, true when every error-severity check passed.

    One ``rollup(tbl)`` aggregation yields the per-table rows and the
    grand total together — a single pass over the check rows.
    """
    err = checks.filter(F.col("severity") == "error")
    rolled = err.rollup("tbl").agg(F.min(F.col("passed").cast("int")).alias("_ok"), F.grouping("tbl").alias("_all"))
    return rolled.select(F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col("tbl")).alias("tbl"),
                         F.coalesce(F.col("_ok"), F.lit(1)).cast("boolean").alias("passed"))


def check_unique(df: DataFrame, keys: list[str], tbl: str) -> DataFrame:
    """Precondition check: rows sharing a key with another row (e.g. (entity, date), (entity, period)).

    One aggregation on the key (partial counts map-side, so a hot key is
    counted, not collected); returns one error-severity check row.
    """
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > 1)
           .agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_d")))
    return dup.select(F.inline(F.array(_row(tbl, "unique_key", ",".join(keys), F.col("_d"), F.lit(0), "error",
                                            F.col("_d") == 0))))
