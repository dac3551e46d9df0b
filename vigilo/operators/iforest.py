"""Isolation forest as a Spark estimator (Liu, Ting & Zhou, 2008).

Plan
* Sampling — every row decides, by a hash of (seed, tree, key), which trees'
  samples it joins (``explode(filter(sequence(0, T-1), ...))``). A row joins
  a tree with probability slightly above psi/n, so only about T * psi rows are
  shuffled whatever n is; each tree then keeps the psi rows with the smallest
  hash (a bounded window group).
* Fit — ``groupBy(tree).applyInPandas`` grows one tree per group: random
  non-constant feature, uniform split point, height limit ceil(log2 psi).
  The node table has at most T * (2 psi - 1) rows — bounded by parameters,
  not by data — and is collected once and broadcast.
* Score — an Arrow ``pandas_udf`` walks all trees level by level for a whole
  batch of rows at once (vectorised numpy), giving the mean path length.

score_samples = -2^(-E[h] / c(psi)); decision = score_samples - offset, where
offset is the ``contamination`` quantile of the training scores (M4);
flagged <=> decision < 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EULER_GAMMA = 0.5772156649

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
])


def average_path_length(m):
    """c(m): average unsuccessful-search path length in a BST of m points."""
    m = np.asarray(m, dtype=float)
    out = np.zeros_like(m)
    two = m == 2
    big = m > 2
    out[two] = 1.0
    mb = m[big]
    out[big] = 2.0 * (np.log(mb - 1.0) + EULER_GAMMA) - 2.0 * (mb - 1.0) / mb
    return out


def _grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Grow one isolation tree; returns (node, left, right, feature, threshold, size, depth) rows."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, -1, 0)]  # rows, depth, parent, side
    while stack:
        rows, depth, parent, side = stack.pop()
        nid = len(nodes)
        nodes.append([nid, -1, -1, -1, 0.0, len(rows), depth])
        if parent >= 0:
            nodes[parent][1 if side == 0 else 2] = nid
        if depth >= max_depth or len(rows) <= 1:
            continue
        sub = x[rows]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            continue
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        if thr >= hi[f]:
            thr = float(lo[f])
        go_left = sub[:, f] <= thr
        nodes[nid][3], nodes[nid][4] = f, thr
        # right pushed first so the left child gets the next id (depth-first order)
        stack.append((rows[~go_left], depth + 1, nid, 1))
        stack.append((rows[go_left], depth + 1, nid, 0))
    return [tuple(n) for n in nodes]


@dataclass
class IsolationForestModel:
    features: list[str]
    psi: int
    nodes: pd.DataFrame  # NODE_SCHEMA rows
    offset: float | None = None
    _arrays: dict = field(default=None, repr=False)

    def arrays(self):
        if self._arrays is None:
            nd = self.nodes.sort_values(["tree", "node"])
            trees = sorted(nd["tree"].unique())
            width = int(nd.groupby("tree")["node"].max().max()) + 1
            shape = (len(trees), width)
            left = np.full(shape, -1, np.int32)
            right = np.full(shape, -1, np.int32)
            feat = np.full(shape, -1, np.int32)
            thr = np.zeros(shape)
            leaf_len = np.zeros(shape)
            for i, t in enumerate(trees):
                g = nd[nd["tree"] == t]
                idx = g["node"].to_numpy()
                left[i, idx] = g["left"].to_numpy()
                right[i, idx] = g["right"].to_numpy()
                feat[i, idx] = g["feature"].to_numpy()
                thr[i, idx] = g["threshold"].to_numpy()
                leaf_len[i, idx] = g["depth"].to_numpy() + average_path_length(g["size"].to_numpy())
            self._arrays = dict(left=left, right=right, feat=feat, thr=thr, leaf_len=leaf_len,
                                c_psi=float(average_path_length([self.psi])[0]))
        return self._arrays

    def score_samples(self, df: DataFrame, out_col: str = "score") -> DataFrame:
        """M3: adds ``score`` = -2^(-E[h]/c(psi)) (higher = more normal)."""
        spark = df.sparkSession
        bc = spark.sparkContext.broadcast(self.arrays())

        @F.pandas_udf(T.DoubleType())
        def _score(*cols: pd.Series) -> pd.Series:
            a = bc.value
            x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
            n_trees = a["left"].shape[0]
            total = np.zeros(len(x))
            rows = np.arange(len(x))
            for t in range(n_trees):
                left, right, feat, thr = a["left"][t], a["right"][t], a["feat"][t], a["thr"][t]
                node = np.zeros(len(x), dtype=np.int64)
                while True:
                    f = feat[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    xv = x[rows, np.where(inner, f, 0)]
                    nxt = np.where(xv <= thr[node], left[node], right[node])
                    node = np.where(inner, nxt, node)
                total += a["leaf_len"][t][node]
            mean_len = total / n_trees
            return pd.Series(-np.power(2.0, -mean_len / a["c_psi"]))

        return df.withColumn(out_col, _score(*[F.col(c).cast("double") for c in self.features]))

    def score_in_plan(self, df: DataFrame, out_col: str = "score") -> DataFrame:
        """M3 without a Python worker: the trees are constant arrays of the plan (a scalar subquery over the node table),
        walked per row by higher-order functions. The same scores as :meth:`score_samples`; that one is faster where
        Python workers are at hand, as it walks a whole batch at once."""
        a = self.arrays()
        width = a["left"].shape[1]
        tree, node = np.nonzero((a["leaf_len"] > 0) | (a["feat"] >= 0) | (np.arange(width) == 0))
        at = {(t, n): i for i, (t, n) in enumerate(zip(tree.tolist(), node.tolist()))}
        go = lambda side: [at.get((t, int(a[side][t, n])), -1) for t, n in zip(tree.tolist(), node.tolist())]
        rows = list(zip(range(len(tree)), go("left"), go("right"), a["feat"][tree, node].tolist(),
                        a["thr"][tree, node].tolist(), a["leaf_len"][tree, node].tolist()))
        spark = df.sparkSession
        table = spark.createDataFrame(rows, "i int, l int, r int, f int, t double, len double")  # bounded by the parameters
        forest = (table.agg(F.array_sort(F.collect_list(F.struct("i", "l", "r", "f", "t", "len"))).alias("n"))
                  .select(F.struct(*[F.col("n")[c].alias(c) for c in ("l", "r", "f", "t", "len")])).scalar())
        roots = [at[t, 0] for t in range(a["left"].shape[0])]
        levels = int(self.nodes["depth"].max())
        columns = df.columns
        x = F.array(*[F.col(c).cast("double") for c in self.features])
        data = df.withColumns({"_x": x, "_forest": forest})
        forest, x = F.col("_forest"), F.col("_x")

        def step(n, _):
            f = F.get(forest["f"], n)
            down = F.when(F.get(x, f) <= F.get(forest["t"], n), F.get(forest["l"], n)).otherwise(F.get(forest["r"], n))
            return F.when(f < 0, n).otherwise(down)

        def length(root):
            leaf = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), root, step) if levels else root
            return F.get(forest["len"], leaf)

        total = F.aggregate(F.array(*[F.lit(i) for i in roots]), F.lit(0.0), lambda acc, root: acc + length(root))
        score = -F.pow(F.lit(2.0), -(total / F.lit(float(len(roots)))) / F.lit(a["c_psi"]))
        return data.select(*columns, score.alias(out_col))

    def decision(self, df: DataFrame) -> DataFrame:
        """decision = score - offset; flagged when decision < 0."""
        if self.offset is None:
            raise ValueError("model has no offset; fit with contamination or set one")
        s = self.score_samples(df)
        d = F.col("score") - F.lit(float(self.offset))
        return s.withColumn("decision", d).withColumn("is_flagged", d < 0)


class IsolationForest:
    """Estimator: ``fit(df)`` -> :class:`IsolationForestModel`."""

    def __init__(self, features: list[str], n_trees: int = 100, max_samples: int = 256,
                 contamination: float | None = 0.1, seed: int = 42, key_col: str = "id"):
        self.features, self.n_trees, self.max_samples = list(features), n_trees, max_samples
        self.contamination, self.seed, self.key_col = contamination, seed, key_col

    def sample(self, df: DataFrame, n: int) -> tuple[DataFrame, int]:
        psi = min(self.max_samples, n)
        # oversample by ~6 standard deviations so every tree almost surely gets psi rows
        frac = min(1.0, (psi + 6.0 * math.sqrt(psi) + 10.0) / n)
        seed, key = self.seed, self.key_col

        def u(t):
            h = F.xxhash64(F.lit(seed), t, F.col(key))
            return F.pmod(h, F.lit(1 << 32)).cast("double") / F.lit(float(1 << 32))
        trees = F.sequence(F.lit(0), F.lit(self.n_trees - 1))
        tagged = df.select(*self.features, key,
                           F.explode(F.filter(trees, lambda t: u(t) < F.lit(frac))).alias("tree"))
        tagged = tagged.withColumn("_h", F.xxhash64(F.lit(seed + 1), F.col("tree"), F.col(key)))
        w = Window.partitionBy("tree").orderBy("_h", key)
        picked = tagged.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi)
        return picked.select("tree", *self.features), psi

    def fit(self, df: DataFrame) -> IsolationForestModel:
        return self.fit_score(df, keep=[])[0]

    def fit_score(self, df: DataFrame, keep: list[str] | None = None) -> tuple[IsolationForestModel, DataFrame]:
        """Fit, and score the training rows once: the same pass gives the offset and the decisions.

        Returns the model and the training rows (key, ``keep`` columns, score,
        decision, is_flagged), pinned in the checkpoint folder — the forest
        walk over every row is the costly part, so it is not repeated.
        """
        from vigilo.session import pin
        keep = [c for c in (keep if keep is not None else df.columns) if c not in (self.key_col, *self.features)]
        # the training table (one row per entity) is read by the count, the
        # sampling and the scoring pass: keep it for the duration of the fit
        data = df.select(self.key_col, *self.features, *keep).persist()
        try:
            model = self._fit(data)
            scored = pin(model.score_samples(data))
        finally:
            data.unpersist()
        if self.contamination is not None:
            from vigilo.operators.thresholds import contamination_offset
            model.offset = contamination_offset(scored, "score", self.contamination)
            d = F.col("score") - F.lit(float(model.offset))
            scored = scored.withColumn("decision", d).withColumn("is_flagged", d < 0)
        return model, scored

    def _fit(self, df: DataFrame) -> IsolationForestModel:
        n = df.count()
        if n < 2:
            raise ValueError("isolation forest needs at least 2 rows")
        sample, psi = self.sample(df, n)
        max_depth = int(math.ceil(math.log2(max(psi, 2))))
        feats, seed = self.features, self.seed

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            t = int(pdf["tree"].iloc[0])
            rng = np.random.default_rng([seed, t])
            x = pdf[feats].to_numpy(dtype=float)
            rows = _grow_tree(x, rng, max_depth)
            out = pd.DataFrame(rows, columns=["node", "left", "right", "feature", "threshold", "size", "depth"])
            out.insert(0, "tree", t)
            return out.astype({"tree": "int32", "node": "int32", "left": "int32", "right": "int32",
                               "feature": "int32", "size": "int32", "depth": "int32"})

        nodes = sample.groupBy("tree").applyInPandas(build, NODE_SCHEMA)
        node_pdf = nodes.toPandas()  # <= n_trees * (2 * psi - 1) rows: bounded by parameters
        return IsolationForestModel(self.features, psi, node_pdf)
