"""Leak-free per-entity payment features from per-period rows.

The latest period of each entity is the label; all earlier periods are the
history, however many. Periods are unique per (entity, period). Everything is
partial aggregation: sums over all periods less the latest one's share, and the
worst earlier status from one row per (entity, status), so an entity with a
third of all periods is pre-aggregated before any shuffle. Amounts are summed
as decimals (six places), so results do not depend on the order of summation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.functions import (
    rint_round, encode_ordinal, default_target, is_low_income, has_many_siblings,
    was_late_or_worse, days_x_outstanding,
)

PERIOD_COLS = dict(id_col="id", term_col="term", status_col="status",
                   days_col="days_since_last_payment", income_col="family_income_bracket",
                   transport_col="transport_user", siblings_col="sibling_count",
                   outstanding_col="total_outstanding")


AMOUNT = "decimal(38,6)"


def _per_entity(df: DataFrame, id_col: str, term_col: str, status_col: str | None = None, days_col: str | None = None,
                outstanding_col: str | None = None, latest_cols: tuple = ()) -> DataFrame:
    """One row per entity: ``_n``, ``_last`` (struct of the latest period) and the history's aggregates asked for."""
    by_status = [status_col] if status_col else []
    own = [F.col(term_col).alias("_t")]
    first = [F.count(F.lit(1)).alias("_n"), F.max(term_col).alias("_mt")]
    if days_col:
        own.append(F.col(days_col).cast("double").alias("_days"))
        first += [F.sum(F.col(days_col).cast("double")).alias("_sum_days"), F.count(days_col).alias("_n_days")]
    if outstanding_col:
        own.append(F.col(outstanding_col).cast(AMOUNT).alias("_out"))
        first += [F.sum(F.col(outstanding_col).cast(AMOUNT)).alias("_sum_out"), F.count(outstanding_col).alias("_n_out")]
    own += [F.col(c) for c in latest_cols]
    parts = df.groupBy(id_col, *by_status).agg(F.max_by(F.struct(*own), term_col).alias("_last"), *first)
    total = parts.groupBy(id_col).agg(
        F.max_by("_last", "_mt").alias("_last"), F.sum("_n").alias("_n"),
        *[F.sum(c).alias(c) for c in ("_sum_days", "_n_days", "_sum_out", "_n_out") if c in parts.columns],
        *([F.max_by(status_col, "_mt").alias("_label"),
           # the two worst statuses with the number of their periods: enough to leave the latest one out
           F.sort_array(F.collect_list(F.struct(F.col(status_col).alias("st"), "_n")), asc=False).alias("_worst")] if status_col else []))
    if status_col:
        earlier = F.filter("_worst", lambda w: w["st"].isNotNull() & ((w["st"] != F.col("_label")) | F.col("_label").isNull() | (w["_n"] > 1)))
        total = total.withColumn("_hist_status", F.get(earlier, F.lit(0))["st"])
    return total


def _hist_mean(total: str, count: str, latest: str, places: int):
    """Mean over the history from the totals: the latest period's value is taken out again."""
    last = F.col("_last")[latest]
    n = F.col(count) - F.when(last.isNotNull(), 1).otherwise(0)
    rest = F.col(total) - F.when(last.isNotNull(), last).otherwise(F.lit(0))
    return F.when(n > 0, rint_round(rest.cast("double") / n, places))


def split_latest(df: DataFrame, id_col: str = "id", term_col: str = "term",
                 status_col: str = "status") -> DataFrame:
    """per entity the latest period (term, status as label) and the history size."""
    return df.groupBy(id_col).agg(
        F.max(term_col).alias("label_term"),
        F.max_by(status_col, term_col).alias("label"),
        (F.count(F.lit(1)) - 1).alias("n_history"))


def history_avg_days(df: DataFrame, id_col: str = "id", term_col: str = "term",
                     days_col: str = "days_since_last_payment") -> DataFrame:
    """mean of the history's days, 1 decimal (half-even)."""
    e = _per_entity(df, id_col, term_col, days_col=days_col)
    return e.select(id_col, _hist_mean("_sum_days", "_n_days", "_days", 1).alias(days_col))


def history_worst_status(df: DataFrame, id_col: str = "id", term_col: str = "term",
                         status_col: str = "status") -> DataFrame:
    """worst (max) status of the history."""
    return (_per_entity(df, id_col, term_col, status_col=status_col)
            .select(id_col, F.col("_hist_status").alias("previous_term_status")))


def history_avg_outstanding(df: DataFrame, id_col: str = "id", term_col: str = "term",
                            outstanding_col: str = "total_outstanding") -> DataFrame:
    """mean of the history's outstanding amount, 2 decimals (half-even)."""
    e = _per_entity(df, id_col, term_col, outstanding_col=outstanding_col)
    return e.select(id_col, _hist_mean("_sum_out", "_n_out", "_out", 2).alias(outstanding_col))


def period_features(df: DataFrame, id_col: str = "id", term_col: str = "term",
                    status_col: str = "status", days_col: str = "days_since_last_payment",
                    income_col: str = "family_income_bracket", transport_col: str = "transport_user",
                    siblings_col: str = "sibling_count", outstanding_col: str = "total_outstanding",
                    keep_no_history: bool = False) -> DataFrame:
    """one row per entity — history features + latest-period attributes + label.

    Entities with a single period have no history; they are dropped unless
    ``keep_no_history`` (then history features are NULL).
    """
    df = df.withColumn("_income", encode_ordinal(income_col))
    e = _per_entity(df, id_col, term_col, status_col, days_col, outstanding_col, ("_income", transport_col, siblings_col))
    if not keep_no_history:
        e = e.filter(F.col("_n") > 1)
    return e.select(
        id_col,
        _hist_mean("_sum_days", "_n_days", "_days", 1).alias("days_since_last_payment"),
        F.col("_hist_status").cast("int").alias("previous_term_status"),
        _hist_mean("_sum_out", "_n_out", "_out", 2).alias("total_outstanding"),
        F.col("_last._income").alias("income_encoded"),
        F.col("_last")[transport_col].cast("int").alias("transport_user"),
        F.col("_last")[siblings_col].cast("int").alias("sibling_count"),
        F.col("_label").cast("int").alias("label"))


def model_inputs(features: DataFrame) -> DataFrame:
    """Default target and the four derived inputs of the binary default model."""
    return features.select(
        "*",
        default_target("label").alias("fee_default"),
        is_low_income("income_encoded").alias("is_low_income"),
        has_many_siblings("sibling_count").alias("has_many_siblings"),
        was_late_or_worse("previous_term_status").alias("was_late_or_worse"),
        days_x_outstanding("days_since_last_payment", "total_outstanding").alias("days_x_outstanding"),
    )


# Feature lists of the two default models (fixed values of the reference).
STATUS_FEATURES = ["days_since_last_payment", "previous_term_status", "total_outstanding",
                   "income_encoded", "transport_user", "sibling_count"]
BINARY_FEATURES = STATUS_FEATURES + ["is_low_income", "has_many_siblings", "was_late_or_worse",
                                     "days_x_outstanding"]
