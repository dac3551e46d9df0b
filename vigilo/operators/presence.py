"""Per-entity presence features from a daily presence table.

Input rows are (entity, date, 0/1) with (entity, date) unique — one row per
entity per day, so an entity never holds more than a calendar's worth of rows.
Every feature is computed from ONE id-partitioned pass: a window over
``partitionBy(id).orderBy(date)`` annotates each row, and a single
``groupBy(id)`` with conditional aggregates produces all features. The
window's shuffle is reused by the aggregate (same partitioning), so the
whole feature table costs one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RECENT_N = 30  # "last 30 days" = last 30 records (fixed value of the reference)


def business_days(df: DataFrame, date_col: str = "date") -> DataFrame:
    """A0: keep Monday–Friday rows (``weekday``: Monday = 0)."""
    return df.filter(F.weekday(F.col(date_col)) < 5)


def _annotate(df: DataFrame, id_col: str, date_col: str, flag_col: str) -> DataFrame:
    """Row position, row count and position of the last present row so far."""
    w = Window.partitionBy(id_col).orderBy(date_col)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (df.withColumn("_rn", F.row_number().over(w))
              .withColumn("_n", F.count(F.lit(1)).over(w_all))
              .withColumn("_last_present",
                          F.max(F.when(F.col(flag_col) == 1, F.col("_rn"))).over(w_run)))


def _rate(flag_col: str) -> Column:
    return F.avg(F.col(flag_col).cast("double"))


def _streak(flag_col: str) -> Column:
    # an absent row ends a run of length rn - (position of the last present row)
    run = F.col("_rn") - F.coalesce(F.col("_last_present"), F.lit(0))
    return F.coalesce(F.max(F.when(F.col(flag_col) == 0, run)), F.lit(0)).cast("int")


def _recent_absences(flag_col: str, n: int) -> Column:
    recent = F.col("_rn") > F.col("_n") - F.lit(n)
    return F.coalesce(F.sum(F.when(recent, 1 - F.col(flag_col))), F.lit(0)).cast("int")


def _weekday_sums(date_col: str, flag_col: str) -> list[Column]:
    wd = F.weekday(F.col(date_col))
    out = []
    for k in range(7):
        out.append(F.sum(F.when(wd == k, F.col(flag_col))).cast("double").alias(f"_s{k}"))
        out.append(F.count(F.when(wd == k, F.lit(1))).alias(f"_c{k}"))
    return out


def _with_weekday_variance(agg: DataFrame, keep: list[str]) -> DataFrame:
    """Sample variance of the per-weekday means over the weekdays that occur.

    Staged through projections so the mean array is built once per row.
    """
    means = F.array(*[F.try_divide(F.col(f"_s{k}"), F.col(f"_c{k}")) for k in range(7)])
    staged = agg.select(*keep, F.filter(means, lambda x: x.isNotNull()).alias("_m"))
    staged = staged.select(*keep, "_m", F.size("_m").cast("double").alias("_k"))
    staged = staged.select(*keep, "_m", "_k",
                           (F.aggregate("_m", F.lit(0.0), lambda a, x: a + x) / F.col("_k")).alias("_mu"))
    ss = F.aggregate("_m", F.lit(0.0), lambda a, x: a + (x - F.col("_mu")) * (x - F.col("_mu")))
    return staged.select(*keep, F.when(F.col("_k") > 1, ss / (F.col("_k") - 1)).alias("day_of_week_variance"))


def presence_rate(df: DataFrame, id_col: str = "id", flag_col: str = "is_present") -> DataFrame:
    """A1: mean of the 0/1 flag per entity."""
    return df.groupBy(id_col).agg(_rate(flag_col).alias("attendance_rate"))


def longest_absence_streak(df: DataFrame, id_col: str = "id", date_col: str = "date",
                           flag_col: str = "is_present") -> DataFrame:
    """A2: longest run of consecutive absent records; never absent -> 0."""
    return (_annotate(df, id_col, date_col, flag_col)
            .groupBy(id_col).agg(_streak(flag_col).alias("longest_absence_streak")))


def absences_in_last_n(df: DataFrame, n: int = RECENT_N, id_col: str = "id", date_col: str = "date",
                       flag_col: str = "is_present") -> DataFrame:
    """A3: absences among the last ``n`` records (all records when fewer)."""
    return (_annotate(df, id_col, date_col, flag_col)
            .groupBy(id_col).agg(_recent_absences(flag_col, n).alias("absence_in_last_n")))


def weekday_presence_variance(df: DataFrame, id_col: str = "id", date_col: str = "date",
                              flag_col: str = "is_present") -> DataFrame:
    """A4: sample variance of the mean presence per weekday; one weekday -> NULL."""
    return _with_weekday_variance(df.groupBy(id_col).agg(*_weekday_sums(date_col, flag_col)), [id_col])


def presence_features(df: DataFrame, id_col: str = "id", date_col: str = "date",
                      flag_col: str = "is_present", recent_n: int = RECENT_N,
                      recent_name: str = "absence_in_last_30_days") -> DataFrame:
    """A5: A1–A4 in one id-partitioned pass, one row per entity."""
    agg = (_annotate(df, id_col, date_col, flag_col)
           .groupBy(id_col)
           .agg(_rate(flag_col).alias("attendance_rate"),
                _streak(flag_col).alias("longest_absence_streak"),
                _recent_absences(flag_col, recent_n).alias(recent_name),
                *_weekday_sums(date_col, flag_col)))
    return _with_weekday_variance(agg, [id_col, "attendance_rate", "longest_absence_streak", recent_name])


def attach_labels(features: DataFrame, dim: DataFrame, id_col: str = "id",
                  label_col: str = "is_anomaly") -> DataFrame:
    """Inner join on id taking only the label column (no other dimension column leaks)."""
    return features.join(dim.select(id_col, label_col), on=id_col, how="inner")
