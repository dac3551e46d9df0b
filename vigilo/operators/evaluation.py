"""Model evaluation over a predictions table (id, y_true, y_pred[, prob]).

Confusion cells, per-class reports and gates come from ONE conditional
aggregation (K*K cells). AUC is exact: a histogram of the scores counts all
pairs between buckets, and only buckets that mix classes are refined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilo.functions import safe_ratio
from vigilo.functions.tiers import STATUS_NAMES


def _cells(pred: DataFrame, classes: list[int], t: str, p: str) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")]
    for a in classes:
        for b in classes:
            aggs.append(F.count(F.when((F.col(t) == a) & (F.col(p) == b), F.lit(1))).alias(f"c_{a}_{b}"))
    return pred.agg(*aggs)


def confusion_matrix(pred: DataFrame, classes: list[int] = (0, 1), t: str = "y_true",
                     p: str = "y_pred") -> DataFrame:
    """One row per actual class with a count column per predicted class (zeros kept)."""
    classes = list(classes)
    cells = _cells(pred, classes, t, p)
    rows = F.array(*[F.struct(F.lit(a).alias("actual"),
                              *[F.col(f"c_{a}_{b}").alias(f"pred_{b}") for b in classes])
                     for a in classes])
    return cells.select(F.inline(rows))


def binary_metrics(pred: DataFrame, t: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Counts, recall, precision, F1, accuracy (zero division -> 0)."""
    c = _cells(pred, [0, 1], t, p)
    tp, fp, fn, tn = F.col("c_1_1"), F.col("c_0_1"), F.col("c_1_0"), F.col("c_0_0")
    recall = safe_ratio(tp, tp + fn)
    precision = safe_ratio(tp, tp + fp)
    return c.select(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
                    recall.alias("recall"), precision.alias("precision"),
                    safe_ratio(F.lit(2.0) * precision * recall, precision + recall).alias("f1"),
                    safe_ratio(tp + tn, F.col("n")).alias("accuracy"))


def classification_report(pred: DataFrame, classes: list[int] = (0, 1, 2), t: str = "y_true",
                          p: str = "y_pred", names: list[str] | None = None) -> DataFrame:
    """Per-class precision/recall/F1/support, then accuracy, macro avg, weighted avg."""
    classes = list(classes)
    names = names or [str(k) for k in classes]
    c = _cells(pred, classes, t, p)
    per = []
    for k in classes:
        tp = F.col(f"c_{k}_{k}")
        sup = sum((F.col(f"c_{k}_{b}") for b in classes), F.lit(0))
        pp = sum((F.col(f"c_{a}_{k}") for a in classes), F.lit(0))
        prec, rec = safe_ratio(tp, pp), safe_ratio(tp, sup)
        per.append((prec, rec, safe_ratio(F.lit(2.0) * prec * rec, prec + rec), sup))
    n = F.col("n")
    K = float(len(classes))
    acc = safe_ratio(sum((F.col(f"c_{k}_{k}") for k in classes), F.lit(0)), n)
    macro = [sum((x[i] for x in per), F.lit(0.0)) / F.lit(K) for i in range(3)]
    weighted = [safe_ratio(sum((x[i] * x[3] for x in per), F.lit(0.0)), n) for i in range(3)]

    def row(label, prec, rec, f1, sup):
        return F.struct(F.lit(label).alias("label"), prec.cast("double").alias("precision"),
                        rec.cast("double").alias("recall"), f1.cast("double").alias("f1"),
                        sup.cast("long").alias("support"))
    rows = [row(nm, *x) for nm, x in zip(names, per)]
    rows.append(row("accuracy", F.lit(None), F.lit(None), acc, n))
    rows.append(row("macro avg", *macro, n))
    rows.append(row("weighted avg", *weighted, n))
    return c.select(F.inline(F.array(*rows)))


def class_recall(pred: DataFrame, cls: int = 2, t: str = "y_true", p: str = "y_pred") -> DataFrame:
    """E5: recall of one class in a multiclass prediction."""
    hit = F.count(F.when((F.col(t) == cls) & (F.col(p) == cls), F.lit(1)))
    sup = F.count(F.when(F.col(t) == cls, F.lit(1)))
    return pred.agg(F.lit(cls).alias("class"), safe_ratio(hit, sup).alias("recall"), sup.alias("support"))


def target_gate(metric: DataFrame, model: str, metric_col: str, minimum: float) -> DataFrame:
    """Acceptance gate on a 1-row metric table."""
    v = F.col(metric_col)
    return metric.select(F.lit(model).alias("model"), F.lit(metric_col).alias("metric"),
                         v.cast("double").alias("value"), F.lit(float(minimum)).alias("minimum"),
                         (v >= F.lit(float(minimum))).alias("passed"))


#: Rows a partition of a prefix sum holds.
PREFIX_ROWS = 200_000


def prefix_sums(df: DataFrame, order_col, value_cols: list[str], partitions: int | None = None) -> DataFrame:
    """Exclusive running sums of ``value_cols`` in ``order_col`` order, fully distributed.

    Rows are range-partitioned once and the split is pinned with a reliable
    ``checkpoint()`` (shared checkpoint folder), so the local running sums
    and the per-partition totals read the *same* partition ids (two sampled
    range shuffles need not agree). Each partition computes its local sums
    in one window task; the per-partition totals (one row per partition — a
    bounded table) give each partition's offset, added by a broadcast join.
    The number of partitions follows the number of rows (PREFIX_ROWS each), not
    the cluster's shuffle setting: a thousand distinct scores are one partition.
    ``order_col`` (a name or a list of names) must be unique per row.
    """
    from vigilo.session import pin
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    held = df.is_cached
    df = df if held else df.persist()
    try:
        n = partitions or max(1, -(-df.count() // PREFIX_ROWS))
        ranged = pin(df.repartitionByRange(n, *order)).withColumn("_pid", F.spark_partition_id())
    finally:
        if not held:
            df.unpersist()
    w_local = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(c).over(w_local), F.lit(0)).alias(f"_loc_{c}") for c in value_cols])
    totals = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_tot_{c}") for c in value_cols])
    w_off = Window.partitionBy(F.lit(1)).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_tot_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}")
                                      for c in value_cols])
    out = local.join(F.broadcast(offsets), "_pid")
    return out.select(*df.columns, *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"below_{c}")
                                     for c in value_cols])


def dense_positions(df: DataFrame, order_cols: list[str], out_col: str = "pos") -> DataFrame:
    """0-based position of every row in ``order_cols`` order (unique), distributed."""
    one = df.withColumn("_one", F.lit(1))
    return prefix_sums(one, order_cols, ["_one"]).withColumnRenamed("below__one", out_col).drop("_one")


#: Buckets of one refinement step, and rows up to which a mixed bucket is ranked value by value.
AUC_BUCKETS = 1 << 16
AUC_RANKED = 1 << 20


def _ordered(score) -> F.Column:
    """Scores as finite numbers in their order: nulls first, NaN last (like Spark's own order), infinities at the ends."""
    s = score.cast("double")
    return (F.when(s.isNull(), F.lit(0).cast("tinyint")).when(F.isnan(s), F.lit(4).cast("tinyint"))
            .when(s == float("-inf"), F.lit(1).cast("tinyint")).when(s == float("inf"), F.lit(3).cast("tinyint"))
            .otherwise(F.lit(2).cast("tinyint")))


def roc_auc(pred: DataFrame, t: str = "y_true", score: str = "prob", round_digits: int | None = None) -> DataFrame:
    """Exact AUC-ROC (ties count one half) from score buckets, without ranking the scores.

    A positive in a higher bucket beats every negative of a lower one, so a
    histogram gives all pairs between buckets exactly. Pairs inside a bucket
    are none when it holds one class, halves when it holds one score; only mixed
    buckets are looked into: small ones (AUC_RANKED rows) by their distinct
    scores, each in a task of its own, larger ones by a histogram over their own
    range, and so on. A step shuffles at most AUC_BUCKETS counts per task and
    open bucket. Pairs are summed as whole numbers.

    ``round_digits`` optionally rounds scores first. Null scores rank lowest, NaN
    highest; labels other than 1 are negatives. Without both classes the AUC is 0.
    """
    s = F.col(score)
    if round_digits is not None:
        s = F.round(s, round_digits)
    kind = _ordered(s)
    rows = pred.select(kind.alias("kind"), F.when(kind == 2, s.cast("double") + F.lit(0.0)).otherwise(F.lit(0.0)).alias("s"),
                       F.coalesce(F.col(t) == 1, F.lit(False)).alias("hit")).persist()
    try:
        return _auc(rows)
    finally:
        rows.unpersist()


def _counts() -> list[F.Column]:
    return [F.count(F.when(F.col("hit"), 1)).alias("pos"), F.count(F.when(~F.col("hit"), 1)).alias("neg")]


def _doubled_pairs(cells: DataFrame, group: list[str], order: str, own) -> DataFrame:
    """Per cell: twice its positives times the negatives of lower cells of its group, plus what ``own`` counts inside."""
    below = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = "decimal(38,0)"
    cross = F.col("pos").cast(whole) * F.coalesce(F.sum("neg").over(below), F.lit(0)).cast("decimal(19,0)") * F.lit(2)
    return cells.withColumn("pairs", (cross + F.when(own, F.col("pos").cast("decimal(18,0)") * F.col("neg").cast("decimal(18,0)"))
                                      .otherwise(F.lit(0))).cast(whole))


def _auc(rows: DataFrame) -> DataFrame:
    from vigilo.session import pin
    spark = rows.sparkSession
    # The root: kinds in order; finite scores (kind 2) are the only bucket with an inside.
    root = rows.groupBy("kind").agg(*_counts(), F.min("s").alias("lo"), F.max("s").alias("hi")).collect()
    root.sort(key=lambda r: r["kind"])
    pos, neg = sum(r["pos"] for r in root), sum(r["neg"] for r in root)
    doubled, below = 0, 0
    for r in root:
        doubled += 2 * r["pos"] * below + (r["pos"] * r["neg"] if r["lo"] == r["hi"] else 0)
        below += r["neg"]
    mix = [r for r in root if r["kind"] == 2 and r["lo"] < r["hi"] and r["pos"] and r["neg"]]
    inside = rows.where("kind = 2").select(F.lit(0).cast("long").alias("bucket"), "s", "hit")
    pieces, open_buckets = AUC_BUCKETS, None
    while mix:
        # Open buckets stay a table (the first is a constant): each is cut into equal steps of its own range.
        inside = (inside.withColumns({"lo": F.lit(mix[0]["lo"]), "hi": F.lit(mix[0]["hi"])}) if open_buckets is None
                  else inside.join(open_buckets, "bucket"))
        s, lo, hi = F.col("s"), F.col("lo"), F.col("hi")
        # Halves where the range itself overflows; it is never 0 otherwise, as lo < hi.
        share = F.when(hi - lo < float("inf"), (s - lo) / (hi - lo)).otherwise((s / 2 - lo / 2) / (hi / 2 - lo / 2))
        step = F.least(F.floor(share * F.lit(pieces)), F.lit(pieces - 1))
        inside = inside.select("bucket", step.cast("long").alias("piece"), "s", "hit")
        cells = inside.groupBy("bucket", "piece").agg(*_counts(), F.min("s").alias("lo"), F.max("s").alias("hi")).persist()
        mixed = (F.col("pos") > 0) & (F.col("neg") > 0) & (F.col("lo") < F.col("hi"))
        small = F.col("pos") + F.col("neg") <= AUC_RANKED
        total = _doubled_pairs(cells, ["bucket"], "piece", F.col("lo") == F.col("hi")).agg(
            F.sum("pairs").alias("pairs"), F.count(F.when(mixed & small, 1)).alias("small"),
            F.count(F.when(mixed & ~small, 1)).alias("large")).first()
        doubled += int(total["pairs"])
        if total["small"]:
            scores = (inside.join(cells.where(mixed & small).select("bucket", "piece"), ["bucket", "piece"], "left_semi")
                      .groupBy("bucket", "piece", "s").agg(*_counts()))
            doubled += int(_doubled_pairs(scores, ["bucket", "piece"], "s", F.lit(True)).agg(F.sum("pairs")).first()[0])
        if not total["large"]:
            cells.unpersist()
            break
        numbered = pin(cells.where(mixed & ~small).select("bucket", "piece", "lo", "hi", F.monotonically_increasing_id().alias("new")))
        cells.unpersist()
        inside = (inside.join(numbered.select("bucket", "piece", "new"), ["bucket", "piece"])
                  .select(F.col("new").alias("bucket"), "s", "hit"))
        open_buckets = numbered.select(F.col("new").alias("bucket"), "lo", "hi")
        pieces = max(2, AUC_BUCKETS // min(AUC_BUCKETS // 2, total["large"]))
    auc = doubled / (2 * pos * neg) if pos and neg else 0.0
    return spark.range(1).select(F.lit(float(auc)).alias("auc"))


def top_flagged(scored: DataFrame, n: int = 5) -> DataFrame:
    """Flagged entities by risk (desc, id breaks ties) with the verdict against the label."""
    return (scored.filter(F.col("is_flagged")).orderBy(F.desc("risk_score"), F.asc("id")).limit(n)
            .select("id", "attendance_rate", "risk_score", "longest_absence_streak", "absence_in_last_30_days",
                    F.when(F.col("is_anomaly") == 1, "Correctly Flagged").otherwise("False Positive").alias("verdict")))


def top_default(scored: DataFrame, n: int = 5) -> DataFrame:
    """Highest default probabilities with decoded previous status and verdict."""
    prev = F.try_element_at(F.array(*[F.lit(x) for x in STATUS_NAMES]), F.col("previous_term_status").cast("int") + 1)
    return (scored.orderBy(F.desc("default_prob"), F.asc("id")).limit(n)
            .select("id", "default_prob", "total_outstanding", F.col("days_since_last_payment").cast("int").alias("days_late"),
                    F.coalesce(prev, F.lit("?")).alias("previous_status"),
                    F.when(F.col("label") == 2, "True Default").otherwise("Check Needed").alias("verdict")))


def target_summary(df: DataFrame, target: str = "fee_default") -> DataFrame:
    """Rows, positives, positive %."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(target).cast("long").alias("positives"),
                  (F.avg(F.col(target).cast("double")) * F.lit(100.0)).alias("positive_pct"))
