"""M4 contamination offset, M5 risk, M13 threshold labels, M14 threshold tuning.

Quantiles are exact and distributed: a mergeable sketch brackets the target
ranks, counting passes prove and narrow the bracket, and only what is left in
it is ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.functions import clip
from vigilo.operators.evaluation import prefix_sums

# Fixed values of the reference: the tuning grid 0.10, 0.15, ..., 0.80 and the recall target.
GRID_START_PCT, GRID_STEP_PCT, GRID_STOP_PCT = 10, 5, 80
RECALL_TARGET = 0.70


#: Size of the quantile sketch: its rank error is below one half percent of the rows with odds of 99 in 100.
SKETCH_K = 800
SKETCH_ERROR = 0.005
#: Values that are ranked in the driver at the end; more are narrowed down or ranked distributed.
RANKED = 100_000


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """Linear-interpolated quantile (numpy/percentile_cont rule), computed exactly and without sorting the column.

    h = (n - 1) q; the values at ranks floor(h) and ceil(h) are wanted. A
    mergeable quantile sketch (KLL, one partial aggregation) gives a bracket
    around them. The next pass counts what lies below and inside the bracket,
    which proves it right or wrong, and sketches the inside only; so each pass
    narrows it a hundredfold. What is left is ranked by exact counts of its
    distinct values. The sketch only steers: the result never depends on it.
    Nulls and NaNs do not count; no values give None.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be in [0, 1]")
    vals = df.select(F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v")).persist()
    try:
        return _bracketed_quantile(vals, q)
    finally:
        vals.unpersist()


def _bracketed_quantile(vals: DataFrame, q: float) -> float | None:
    sketch = lambda c: F.kll_sketch_agg_double(c, F.lit(SKETCH_K))
    v = F.col("_v")
    n, lo, hi, seen = vals.agg(F.count("_v"), F.min("_v"), F.max("_v"), sketch(v)).first()
    if not n:
        return None
    h = (n - 1) * q
    first, last = int(h // 1), int(-(-h // 1))
    below, inside = 0, n  # proven: ``below`` values are less than lo, ``inside`` lie in [lo, hi], both ranks among them
    while inside > RANKED and lo < hi:
        new_lo, new_hi = _around(vals.sparkSession, seen, (first - below) / inside, (last - below) / inside, lo, hi)
        if (new_lo, new_hi) == (lo, hi):
            break
        at = F.when(v.between(lo, hi), v)
        mid = F.when(v.between(new_lo, new_hi), v)
        c = vals.agg(F.count(F.when(at < new_lo, 1)).alias("left"), F.count(mid).alias("mid"), sketch(mid).alias("seen"),
                     F.max(F.when(at < new_lo, at)).alias("left_end"), F.min(F.when(at > new_hi, at)).alias("right_start")).first()
        left = below + c["left"]
        if first < left <= last or first < left + c["mid"] <= last:
            # the two ranks lie on two sides of a border: both neighbours are known
            return _interpolated(*((c["left_end"], new_lo) if first < left else (new_hi, c["right_start"])), h - first,
                                 vals, first < left)
        was = inside
        if last < left:        # the sketch was off: the ranks lie below its bracket
            hi, inside = c["left_end"], c["left"]
        elif first >= left + c["mid"]:
            lo, below, inside = c["right_start"], left + c["mid"], inside - c["left"] - c["mid"]
        else:
            lo, hi, below, inside = new_lo, new_hi, left, c["mid"]
        seen = c["seen"] if (lo, hi) == (new_lo, new_hi) else vals.agg(sketch(F.when(v.between(lo, hi), v))).first()[0]
        if inside > 0.5 * was:
            break  # few values hold most rows: counting them is all there is to do
    if lo == hi:
        return lo
    counts = vals.where(v.between(lo, hi)).groupBy("_v").agg(F.count(F.lit(1)).alias("_c"))
    if inside <= RANKED:
        rows = sorted((r["_v"], r["_c"]) for r in counts.collect())  # at most RANKED rows
        return _ranked(rows, first - below, last - below, h - first)
    return _quantile_from_counts(counts, first - below, last - below, h - first)


def _around(spark, seen: bytearray, low_rank: float, high_rank: float, lo: float, hi: float) -> tuple[float, float]:
    """Values of the sketch that bracket two ranks (as shares), with room for its error; the ends where the room runs out."""
    a, b = low_rank - 2 * SKETCH_ERROR, high_rank + 2 * SKETCH_ERROR
    one = spark.createDataFrame([(bytes(seen),)], "s binary")
    at = lambda r: F.kll_sketch_get_quantile_double("s", F.lit(min(1.0, max(0.0, r))))
    got = one.select(at(a), at(b)).first()
    return (max(lo, got[0]) if a > 0 else lo), (min(hi, got[1]) if b < 1 else hi)


def _interpolated(a: float, b: float, share: float, vals: DataFrame, first_is_left: bool) -> float:
    """Between the last value on one side of a bracket's border and the first on the other (the border itself may be no value)."""
    v = F.col("_v")
    if first_is_left:
        b = vals.agg(F.min(F.when(v >= b, v))).first()[0]
    else:
        a = vals.agg(F.max(F.when(v <= a, v))).first()[0]
    return a + share * (b - a)


def _ranked(rows: list[tuple[float, int]], first: int, last: int, share: float) -> float:
    below, found = 0, {}
    for value, count in rows:
        for r in (first, last):
            if below <= r < below + count:
                found[r] = value
        below += count
    return found[first] + share * (found[last] - found[first])


def _quantile_from_counts(counts: DataFrame, first: int, last: int, share: float) -> float:
    """The same from counts too many for the driver: distributed prefix sums, two rows come back."""
    counts = counts.persist()
    try:
        ranked = prefix_sums(counts, "_v", ["_c"])
        at = lambda r: (F.col("below__c") <= r) & (F.col("below__c") + F.col("_c") > r)
        hits = ranked.filter(at(first) | at(last)).select("_v", "below__c", "_c").collect()  # at most 2 rows
    finally:
        counts.unpersist()
    value = lambda r: next(x["_v"] for x in hits if x["below__c"] <= r < x["below__c"] + x["_c"])
    return value(first) + share * (value(last) - value(first))


def contamination_offset(scores: DataFrame, score_col: str = "score", contamination: float = 0.1,
                         exact: bool = True, accuracy: int = 100000) -> float:
    """M4 fit: offset = the ``contamination`` quantile of the training scores.

    ``exact=False`` uses ``percentile_approx`` (one partial aggregation) for
    very large inputs.
    """
    if exact:
        return exact_quantile(scores, score_col, contamination)
    return scores.agg(F.percentile_approx(score_col, contamination, accuracy)).first()[0]


def flag_by_contamination(scores: DataFrame, offset: float, score_col: str = "score") -> DataFrame:
    """M4 transform: decision = score - offset; flagged when decision < 0."""
    d = F.col(score_col) - F.lit(float(offset))
    return scores.select("*", d.alias("decision"), (d < 0).alias("is_flagged"))


def risk_from_decision(decision_col: str = "decision"):
    """M5: clip(100 * (1 - (d + 0.5)), 0, 100)."""
    return clip(F.lit(100.0) * (F.lit(1.0) - (F.col(decision_col) + F.lit(0.5))), 0.0, 100.0)


def threshold_label(p0: str, p1: str, p2: str, threshold: float = 0.5):
    """M13 multiclass rule: p2 >= t -> 2, else the likelier of 0 and 1 (0 wins a tie)."""
    return (F.when(F.col(p2) >= F.lit(float(threshold)), F.lit(2))
             .when(F.col(p0) >= F.col(p1), F.lit(0)).otherwise(F.lit(1)))


def binary_threshold_label(p: str, threshold: float):
    """M13 binary rule: p >= t -> 1."""
    return (F.col(p) >= F.lit(float(threshold))).cast("int")


def grid() -> list[float]:
    return [k / 100 for k in range(GRID_START_PCT, GRID_STOP_PCT + 1, GRID_STEP_PCT)]


def threshold_scan(pred: DataFrame, t: str = "y_true", p: str = "prob") -> DataFrame:
    """M14 scan: tp / fn / fp, recall and precision at every grid threshold.

    ONE pass over the predictions: each row counts under the number of
    thresholds it reaches (one row in, one group of at most 16; partial counts
    cross the shuffle), and sums from the top turn those into the counts per
    threshold and the class totals. No expansion, no cross join, no second scan.
    """
    from pyspark.sql import Window
    from vigilo.functions import safe_ratio
    g = F.array(*[F.lit(x) for x in grid()])
    reached = F.size(F.filter(g, lambda x: F.col(p) >= x))
    hits = pred.groupBy(reached.cast("long").alias("k")).agg(
        F.count(F.when(F.col(t) == 1, F.lit(1))).alias("tp"), F.count(F.when(F.col(t) != 1, F.lit(1))).alias("fp"))
    steps = (GRID_STOP_PCT - GRID_START_PCT) // GRID_STEP_PCT + 1
    # at most 16 rows: how many predictions reach exactly k thresholds; the sums from k upwards are the counts at threshold k
    rows = pred.sparkSession.range(steps + 1).withColumnRenamed("id", "k").join(hits, "k", "left").fillna(0, ["tp", "fp"])
    up = Window.partitionBy(F.lit(1)).orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.select("k", F.sum("tp").over(up).alias("tp"), F.sum("fp").over(up).alias("fp"),
                      F.sum("tp").over(Window.partitionBy(F.lit(1))).alias("_pos")).where("k > 0")
    threshold = (F.lit(GRID_START_PCT) + (F.col("k") - 1) * F.lit(GRID_STEP_PCT)) / F.lit(100.0)
    return out.select(threshold.alias("threshold"), "tp", (F.col("_pos") - F.col("tp")).alias("fn"), "fp",
                      safe_ratio(F.col("tp"), F.col("_pos")).alias("recall"),
                      safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def tune_threshold(scan: DataFrame, target: float = RECALL_TARGET) -> DataFrame:
    """M14 pick: highest and lowest grid thresholds whose recall reaches ``target``.

    Recall only falls as the threshold rises, so "lowest" is the grid start
    whenever any threshold qualifies; "highest" is the useful choice.
    """
    ok = scan.filter(F.col("recall") >= F.lit(float(target)))
    return ok.agg(F.max("threshold").alias("highest"), F.min("threshold").alias("lowest"),
                  F.count(F.lit(1)).alias("qualifying"))
