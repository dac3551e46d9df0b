"""M9: multinomial gradient boosting — K regression trees a round from one shared gradient pass.

One model of all classes: scores F_k start at the log priors, a round computes
p = softmax(F) once per row, fits one tree per class to the residuals
[y = k] - p_k, and adds its leaf values times the learning rate. All trees of a
round grow together, level by level: a level is one job over the rows for all
classes and open nodes, whose tasks hand on histograms (class, node, feature,
bin) -> (rows, weight, weighted residual, curvature), one per task, class and
node. They are summed by class and node in a shuffle, and each sum's best split is
found where it was summed: the driver gets a few numbers per node, whatever the
rows and bins. Splits maximise the weighted
variance reduction; leaves take the second-order (Newton) step
(K - 1) / K * sum(w r) / sum(w |r| (1 - |r|)).

Rows live as blocks of binned features with their current scores. That loop is
numeric state per partition, changed every round, so it is an RDD of numpy
blocks: kept in memory or on disk, checkpointed every CHECKPOINT_EVERY rounds
into the shared folder, so a lost executor costs a few rounds of one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Candidate cuts of a feature: midpoints of its distinct values, or of this many quantiles when it has more.
MAX_BINS = 256
#: Rows of a block, and rows a partition holds at least (every level is a job over all partitions).
BLOCK_ROWS = 50_000
PARTITION_ROWS = 20_000
#: Rows beyond which a partition is split even if every core has one already.
FULL_ROWS = 1_000_000
CHECKPOINT_EVERY = 20
_COUNT, _WEIGHT, _RESIDUAL, _CURVE = range(4)
_TIE = 1e-10  # gains this close are equal: the lowest feature and cut win, whatever order sums were merged in


def _cuts(df: DataFrame, features: list[str]) -> list[list[float]]:
    """Candidate thresholds per feature, one job: all distinct values where they are few, else quantiles."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v"))
                                        for i, c in enumerate(features)])))
    first = Window.partitionBy("f").orderBy("v")
    few = (long.distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= MAX_BINS + 1))
    found: list[list[float]] = [[] for _ in features]
    for r in few.collect():  # at most features x (MAX_BINS + 1) rows
        found[r["f"]].append(r["v"])
    wide = [i for i, v in enumerate(found) if len(v) > MAX_BINS]
    if wide:
        at = [k / (MAX_BINS - 1) for k in range(MAX_BINS)]
        row = df.agg(*[F.percentile_approx(F.col(features[i]).cast("double"), at, 10 * MAX_BINS).alias(str(i)) for i in wide]).first()
        for i in wide:
            found[i] = list(row[str(i)])
    values = [sorted(set(v)) for v in found]
    return [[(a + b) / 2 for a, b in zip(v, v[1:])] for v in values]


def _blocks(cuts: list[list[float]], classes: tuple):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        held, n = [], 0

        def block():
            df = pd.concat(held, ignore_index=True)
            x = df.iloc[:, 2:].to_numpy(float)
            if np.isnan(x).any():
                raise ValueError("a feature is null: fill it before fitting")
            bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1).astype(np.uint8)
            y = pd.Categorical(df["y"], categories=list(classes)).codes
            if (y < 0).any():
                raise ValueError(f"a label is none of {classes}")
            return pd.DataFrame({"n": [len(df)], "x": [bins.tobytes()], "y": [y.astype(np.uint8).tobytes()],
                                 "w": [df["w"].to_numpy("<f8").tobytes()]})

        for df in batches:
            held.append(df)
            n += len(df)
            if n >= BLOCK_ROWS:
                yield block()
                held, n = [], 0
        if n:
            yield block()

    return run


def _softmax(scores):
    import numpy as np

    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _places(x, feature, cut, depth: int):
    """Heap index that each row reaches in one tree within ``depth`` levels (-1 at a node = a leaf)."""
    import numpy as np

    node, row = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range(depth):
        f = feature[node]
        node = np.where(f < 0, node, 2 * node + 2 - (x[row, np.maximum(f, 0)] <= cut[node]))
    return node


def _loss(block) -> float:
    """Weighted deviance of a block's current scores."""
    import numpy as np

    x, y, w, scores = block
    return float(-(w * np.log(np.maximum(_softmax(scores)[np.arange(len(y)), y], 1e-300))).sum())


def _histograms(level: int, bins: int, feature, cut):
    """Sums of one block for every class and node of a level: (loss, array[class, node, feature, bin, sum])."""
    def run(block):
        import numpy as np

        x, y, w, scores = block
        p = _softmax(scores)
        k_classes, first = scores.shape[1], (1 << level) - 1
        loss = _loss(block) if level == 0 else 0.0
        out = np.zeros((k_classes, 1 << level, x.shape[1], bins, 4))
        for k in range(k_classes):
            node = _places(x, feature[k], cut[k], level) - first
            r = (y == k) - p[:, k]
            sums = (None, w, w * r, w * np.abs(r) * (1 - np.abs(r)))
            inside = np.flatnonzero(node >= 0)
            node = node[inside]
            for j in range(x.shape[1]):
                cell = node * bins + x[inside, j]
                for s, v in enumerate(sums):
                    found = np.bincount(cell, None if v is None else v[inside], minlength=bins << level)
                    out[k, :, j, :, s] = found.reshape(1 << level, bins)
        return loss, out

    return run


def _splits(sums, min_rows: int):
    """Sums and best split of one node from its histogram."""
    return sums[0].sum(0), _best(sums, min_rows)


def _block_splits(block, level: int, bins: int, feature, cut, min_rows: int):
    """Of a single block: (loss, {(class, node of the level): sums and best split} of the nodes with rows)."""
    loss, hist = _histograms(level, bins, feature, cut)(block)
    return loss, {(k, i): _splits(hist[k, i], min_rows) for k in range(hist.shape[0]) for i in range(hist.shape[1])
                  if hist[k, i, 0, :, _COUNT].any()}


def _merged_splits(state, level: int, bins: int, feature, cut, min_rows: int):
    """The same over all blocks, one job: histograms are summed by (class, node), splits found where the sums are."""
    def sums(blocks):
        own, loss, hist = _histograms(level, bins, feature, cut), 0.0, None
        for block in blocks:
            a, h = own(block)
            loss, hist = loss + a, h if hist is None else hist + h
        if hist is not None:
            yield (-1, 0), loss
            yield from (((k, i), hist[k, i]) for k in range(hist.shape[0]) for i in range(hist.shape[1]) if hist[k, i, 0, :, _COUNT].any())

    def best(pair):
        at, own = pair
        return at, own if at[0] < 0 else _splits(own, min_rows)

    nodes = len(feature) << level
    summed = state.mapPartitions(sums).reduceByKey(lambda a, b: a + b, min(state.getNumPartitions(), -(-nodes // 8)))
    found = dict(summed.map(best).collect())  # at most one row per class and node
    return found.pop((-1, 0)), found


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions of training rows that are read again and again: one per core at most, more only for full ones."""
    return max(1, min(-(-rows // PARTITION_ROWS), max(spark.sparkContext.defaultParallelism, -(-rows // FULL_ROWS))))


def _moved(feature, cut, value, depth: int, rate: float):
    def run(block):
        x, y, w, scores = block
        scores = scores.copy()
        for k in range(scores.shape[1]):
            scores[:, k] += rate * value[k][_places(x, feature[k], cut[k], depth)]
        return x, y, w, scores

    return run


def _best(hist, min_rows: int):
    """Best split of one node from its histogram [feature, bin, sum]: (gain, feature, bin, left sums, right sums) or None."""
    import numpy as np

    left = hist.cumsum(1)
    total = left[0, -1]
    right = total - left
    wl, wr = left[..., _WEIGHT], right[..., _WEIGHT]
    allowed = (left[..., _COUNT] >= min_rows) & (right[..., _COUNT] >= min_rows) & (wl > 0) & (wr > 0)
    gap = np.where(allowed, left[..., _RESIDUAL] * wr - right[..., _RESIDUAL] * wl, 0)
    gain = np.where(allowed, gap * gap / np.where(allowed, wl * wr * (wl + wr), 1), 0)
    if gain.max() <= 1e-14 * max(total[_WEIGHT], 1e-300):
        return None
    j, b = np.unravel_index(np.argmax(gain >= gain.max() * (1 - _TIE)), gain.shape)
    return float(gain[j, b]), int(j), int(b), left[j, b], right[j, b]


def _newton(sums, k_classes: int) -> float:
    return 0.0 if abs(sums[_CURVE]) < 1e-150 else (k_classes - 1) / k_classes * float(sums[_RESIDUAL] / sums[_CURVE])


@dataclass
class SoftmaxBoosting:
    """A fitted model: arrays [round, class, heap node] of split features (-1: leaf), thresholds, leaf values and gains."""
    features: list[str]
    classes: tuple
    prior: list[float]
    rate: float
    depth: int
    feature: object
    split_at: object
    value: object
    gain: object
    #: Mean weighted deviance before each round and after the last: one more than there are rounds.
    losses: list[float] = field(default_factory=list)
    threshold: float = 0.5

    @property
    def iterations(self) -> int:
        return len(self.feature)

    def with_threshold(self, threshold: float):
        """The same model with a tuned decision threshold."""
        return replace(self, threshold=float(threshold))

    def _scorer(self):
        features, prior, rate, depth = list(self.features), list(self.prior), self.rate, self.depth
        feature, split_at, value = self.feature, self.split_at, self.value

        @F.pandas_udf("array<double>")
        def proba(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            import numpy as np

            for df in batches:
                x = df[features].to_numpy(float)
                if np.isnan(x).any():
                    raise ValueError("a feature is null: fill it before scoring")
                scores = np.tile(np.array(prior), (len(x), 1))
                for r in range(len(feature)):
                    for k in range(len(prior)):
                        scores[:, k] += rate * value[r, k][_places(x, feature[r, k], split_at[r, k], depth)]
                yield pd.Series(list(_softmax(scores)))

        return proba

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """``df`` with p_<class> per class (they sum to 1); one Arrow pass over all trees for a batch."""
        inputs = F.struct(*[F.col(c).cast("double").alias(c) for c in self.features])
        scored = df.select("*", self._scorer()(inputs).alias("_p"))
        return scored.select(*df.columns, *[F.col("_p")[i].alias(f"p_{k}") for i, k in enumerate(self.classes)])

    def predict(self, df: DataFrame) -> DataFrame:
        """Threshold rule on p_2, else the likelier of 0 and 1."""
        from vigilo.operators.thresholds import threshold_label
        return self.predict_proba(df).withColumn("label_pred", threshold_label("p_0", "p_1", "p_2", self.threshold))

    def feature_importances(self) -> list[float]:
        """Variance reduction by feature, normalised within each tree, averaged over the trees that split, summing to 1."""
        import numpy as np

        total, trees = np.zeros(len(self.features)), 0
        for f, g in zip(self.feature.reshape(-1, self.feature.shape[-1]), self.gain.reshape(-1, self.gain.shape[-1])):
            own = np.bincount(f[f >= 0], g[f >= 0], minlength=len(total))
            if own.sum() > 0:
                total, trees = total + own / own.sum(), trees + 1
        return (total / trees / (total / trees).sum()).tolist() if trees else total.tolist()

    def node_rows(self) -> list[tuple]:
        """(round, class index, heap node, feature index or -1, split_at, value, gain): rounds x classes x 2^(depth+1) rows at most."""
        return [(r, k, i, int(self.feature[r, k, i]), float(self.split_at[r, k, i]), float(self.value[r, k, i]), float(self.gain[r, k, i]))
                for r in range(self.feature.shape[0]) for k in range(self.feature.shape[1]) for i in range(self.feature.shape[2])
                if self.feature[r, k, i] >= 0 or self.value[r, k, i] != 0]

    def save(self, path: str) -> None:
        """Node table and one row of parameters."""
        spark = SparkSession.getActiveSession()
        spark.createDataFrame(self.node_rows(), "round int, class int, node int, feature int, threshold double, value double, gain double"
                              ).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        params = (list(self.features), [int(c) for c in self.classes], [float(x) for x in self.prior], float(self.rate), int(self.depth),
                  int(self.iterations), [float(x) for x in self.losses], float(self.threshold))
        spark.createDataFrame([params], "features array<string>, classes array<int>, prior array<double>, rate double, depth int, "
                              "rounds int, losses array<double>, threshold double").write.mode("overwrite").parquet(f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str):
        import numpy as np

        p = spark.read.parquet(f"{path}/params").first()
        feature, split_at, value, gain = _empty(p["rounds"], len(p["classes"]), p["depth"])
        for r in spark.read.parquet(f"{path}/nodes").collect():
            at = r["round"], r["class"], r["node"]
            feature[at], split_at[at], value[at], gain[at] = r["feature"], r["threshold"], r["value"], r["gain"]
        return cls(list(p["features"]), tuple(p["classes"]), list(p["prior"]), p["rate"], p["depth"],
                   np.asarray(feature), split_at, value, gain, list(p["losses"]), p["threshold"])


def _empty(rounds: int, k_classes: int, depth: int):
    import numpy as np

    shape = (rounds, k_classes, (2 << depth) - 1)
    return np.full(shape, -1, np.int64), np.zeros(shape), np.zeros(shape), np.zeros(shape)


def _round(splits, feature, cut, gain, value):
    """Grow the trees of one round in place, level by level; ``splits(level, feature, cut)`` looks at all rows. Gives the loss."""
    k_classes, depth = len(feature), len(feature[0]).bit_length() - 1
    loss, sums = 0.0, {}
    for level in range(depth):
        at_level, best = splits(level, feature, cut)
        if level == 0:
            loss, sums = at_level, {at: own for at, (own, _) in best.items()}
        first = (1 << level) - 1
        for k, node in [at for at in sums if at[1] >= first]:
            found = best[k, node - first][1]
            if found:
                gain[k, node], feature[k, node], cut[k, node], sums[k, 2 * node + 1], sums[k, 2 * node + 2] = found
                del sums[k, node]
        if not any(node > 2 * first for _, node in sums):
            break  # nothing was split
    for (k, node), own in sums.items():
        value[k, node] = _newton(own, k_classes)
    return loss


def _fitted_in_a_task(block, rounds: int, depth: int, rate: float, bins: int, min_rows: int):
    """All rounds over one block: no sums of other blocks to wait for, so no job per level."""
    import numpy as np

    k_classes = block[3].shape[1]
    feature, _, value, gain = _empty(rounds, k_classes, depth)
    cut, losses = np.zeros(feature.shape, np.int64), []
    for r in range(rounds):
        losses.append(_round(lambda level, f, c: _block_splits(block, level, bins, f, c, min_rows), feature[r], cut[r], gain[r], value[r]))
        block = _moved(feature[r], cut[r], value[r], depth, rate)(block)
    return feature, cut, value, gain, [*losses, _loss(block)]


def fit_softmax_boosting(train: DataFrame, features: list[str], label: str = "label", classes: tuple = (0, 1, 2),
                         weight_col: str | None = None, rounds: int = 200, rate: float = 0.08, depth: int = 4,
                         min_rows: int = 1) -> SoftmaxBoosting:
    """Fit on ``train``; weights default to 1. Deterministic: no sampling, ties go to the lowest feature and cut.

    Training rows that fit one block (PARTITION_ROWS at most) are boosted inside
    the task that holds them, by the same steps: a job per level would only wait
    for itself. Null features and labels outside ``classes`` are errors. A class
    without rows keeps a vanishing prior. No rows at all are an error.
    """
    import numpy as np
    from vigilo.session import ensure_checkpoint_dir, pin

    ensure_checkpoint_dir(train.sparkSession)
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    data = train.select(F.col(label).alias("y"), weight.alias("w"), *[F.col(c).cast("double").alias(c) for c in features]).persist()
    try:
        n = data.count()
        if not n:
            raise ValueError("no training rows")
        cuts = _cuts(data, features)
        stored = pin(data.coalesce(partitions_for(train.sparkSession, n)).mapInPandas(_blocks(cuts, classes), "n int, x binary, y binary, w binary"))
    finally:
        data.unpersist()
    bins, k_classes, width = max(len(c) for c in cuts) + 1, len(classes), len(features)

    def opened(row):
        w = np.frombuffer(row["w"], "<f8")
        return np.frombuffer(row["x"], np.uint8).reshape(row["n"], width), np.frombuffer(row["y"], np.uint8), w

    blocks = stored.rdd.map(opened)
    by_class = blocks.map(lambda b: np.bincount(b[1], b[2], minlength=k_classes)).treeReduce(lambda a, b: a + b)
    all_weight, eps = float(by_class.sum()), float(np.finfo(np.float32).eps)
    prior = np.log(np.clip(by_class / all_weight, eps, 1 - eps))
    state = blocks.map(lambda b: (*b, np.tile(prior, (len(b[1]), 1))))
    if n <= min(PARTITION_ROWS, BLOCK_ROWS):
        feature, cut, value, gain, losses = state.map(lambda b: _fitted_in_a_task(b, rounds, depth, rate, bins, min_rows)).first()
    else:
        feature, _, value, gain = _empty(rounds, k_classes, depth)
        cut, losses, old = np.zeros(feature.shape, np.int64), [], None
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        for r in range(rounds):
            merged = lambda level, f, c: _merged_splits(state, level, bins, f.copy(), c.copy(), min_rows)  # noqa: E731,B023
            losses.append(_round(merged, feature[r], cut[r], gain[r], value[r]))
            if old is not None:
                old.unpersist()
            old, state = state, state.map(_moved(feature[r], cut[r], value[r], depth, rate)).persist(StorageLevel.MEMORY_AND_DISK)
            if (r + 1) % CHECKPOINT_EVERY == 0:
                state.checkpoint()
        losses.append(state.map(_loss).treeReduce(lambda a, b: a + b))
        for x in (old, state):
            if x is not None:
                x.unpersist()
    split_at = np.zeros(feature.shape)
    for at in zip(*np.nonzero(feature >= 0)):
        split_at[at] = cuts[feature[at]][cut[at]]
    return SoftmaxBoosting(list(features), tuple(classes), prior.tolist(), rate, depth, feature, split_at, value, gain,
                           [x / all_weight for x in losses])
