"""M6 stratified split, M10 class weights, M7 minority oversampling (SMOTE).

All randomness is a hash of (key, seed), so results do not depend on
partitioning and re-run identically after an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilo.functions import hash_bits, unit_hash
from vigilo.operators.evaluation import dense_positions


#: A label is a class: more distinct values than this are an error, not a table to broadcast.
MAX_CLASSES = 10_000


def _class_rows(df: DataFrame, label_col: str) -> list:
    rows = df.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label_col} has more than {MAX_CLASSES} distinct values: not a class label")
    return rows


def stratified_split(df: DataFrame, label_col: str, test_fraction: float = 0.2, seed: int = 42,
                     key_col: str = "id") -> DataFrame:
    """M6: adds ``split`` = 'test' / 'train'; of every class exactly round(n * fraction) rows are test rows.

    A class's test rows are those with the smallest hash of their key (ties by
    key). No class is sorted: a histogram of the hash (4,096 buckets a class,
    partial counts) tells the bucket in which the class's cut falls; buckets
    below are test, above train, and only the rows of the cut bucket are ranked.
    """
    d = df.withColumn("_h", hash_bits(key_col, seed=seed)).withColumn("_b", F.shiftright("_h", 40))
    up = Window.partitionBy(label_col).orderBy("_b")
    hist = (d.groupBy(label_col, "_b").agg(F.count(F.lit(1)).alias("_c"))
            .withColumn("_upto", F.sum("_c").over(up))
            .withColumn("_want", F.floor(F.sum("_c").over(Window.partitionBy(label_col)) * F.lit(float(test_fraction)) + F.lit(0.5))))
    cuts = hist.where((F.col("_upto") - F.col("_c") < F.col("_want")) & (F.col("_upto") >= F.col("_want")))
    cuts = cuts.select(F.col(label_col).alias("_l"), F.col("_b").alias("_cut"), (F.col("_want") - F.col("_upto") + F.col("_c")).alias("_need"))
    known = df.sparkSession.createDataFrame(_class_rows(cuts, label_col), cuts.schema)
    d = d.join(F.broadcast(known), F.col(label_col).eqNullSafe(F.col("_l")), "left")
    at_cut = F.coalesce(F.col("_b") == F.col("_cut"), F.lit(False))
    rank = F.row_number().over(Window.partitionBy(label_col).orderBy("_h", key_col))
    inside = d.where(at_cut).withColumn("split", F.when(rank <= F.col("_need"), "test").otherwise("train"))
    outside = d.where(~at_cut).withColumn("split", F.when(F.col("_b") < F.col("_cut"), "test").otherwise("train"))
    return outside.unionByName(inside).drop("_h", "_b", "_l", "_cut", "_need")


def class_weights(df: DataFrame, label_col: str = "label", mode: str = "fixed", minority: int = 2,
                  factor: float = 4.0) -> DataFrame:
    """Adds ``weight``.

    fixed: ``factor`` for the ``minority`` class, else 1. balanced: n / (K * n_c)
    from the class counts (one row per class; at most MAX_CLASSES, checked, joined
    on the label, broadcast).
    """
    if mode == "fixed":
        return df.withColumn("weight", F.when(F.col(label_col) == minority, F.lit(float(factor))).otherwise(F.lit(1.0)))
    if mode != "balanced":
        raise ValueError(f"unknown weight mode {mode!r}")
    counts = _class_rows(df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc")), label_col)
    total = sum(r["_nc"] for r in counts)
    schema = df.select(label_col).schema.add("weight", "double")
    weights = df.sparkSession.createDataFrame([(r[0], total / (len(counts) * r["_nc"])) for r in counts], schema)
    return df.join(F.broadcast(weights), label_col, "left")


def knn_within(df: DataFrame, features: list[str], k: int = 3, key_col: str = "id", **kw) -> DataFrame:
    """Exact k nearest neighbours (Euclidean, ties by key) of every row among the others.

    Groups of identical vectors (copies) are split off first, so a copy group
    holding a third of the rows costs O(rows), not O(rows^2):
    * a row's nearest copies are the smallest other ids of its group, taken
      from the group's first k+1 ids (a group-limited top-k, partial before
      the exchange);
    * only vectors with at most k copies need other vectors: the search by
      cells (:func:`nearest_vectors`) runs over distinct vectors (represented
      by their smallest id), and each neighbour vector expands to its first k
      ids. Ordering vectors by (distance, smallest id) contains the best
      members by (distance, id).
    Returns (id, nbr_id, nn, dist), nn = 1..min(k, n-1).
    """
    from vigilo.operators.nearest import nearest_vectors
    from vigilo.operators.topk import top_k_per_group
    from vigilo.session import pin
    feats = list(features)
    # read by the copy grouping, the counts, the distinct search and the final joins: pin it once
    base = pin(df.select(F.col(key_col).alias("id"), *feats))
    firsts = top_k_per_group(base, feats, [F.asc("id")], k + 1, rank_col="_r").select(*feats, "id")
    groups = pin(base.groupBy(*feats).agg(F.count(F.lit(1)).alias("_s"), F.min("id").alias("_rep")))
    # distance-0 neighbours: the smallest other ids of the row's own copy group
    copies = (base.join(firsts.withColumnRenamed("id", "nbr_id"), feats)
              .filter(F.col("nbr_id") != F.col("id"))
              .select("id", "nbr_id", F.lit(0.0).alias("dist")))
    reps = groups.select(F.col("_rep").alias("id"), (F.col("_s") <= k).alias("ask"), *feats)
    n_vec = groups.count()
    cands = copies
    if n_vec >= 2:
        near = nearest_vectors(reps, feats, k, **kw)
        vec_nn = (near.withColumn("nn", F.row_number().over(Window.partitionBy("id").orderBy("dist", "nbr_id")))
                  .filter(F.col("nn") <= k))  # (rep, neighbour rep, dist)
        members = firsts.join(groups.select(*feats, "_rep"), feats).select(F.col("_rep").alias("nbr_rep"),
                                                                           F.col("id").alias("nbr_id"))
        other = (vec_nn.select(F.col("id").alias("_rep"), F.col("nbr_id").alias("nbr_rep"), "dist")
                 .join(members, "nbr_rep").drop("nbr_rep"))
        rows_small = base.join(groups.filter(F.col("_s") <= k).select(*feats, "_rep"), feats).select("id", "_rep")
        cands = cands.unionByName(rows_small.join(other, "_rep").select("id", "nbr_id", "dist"))
    n = base.count()
    k_eff = min(k, n - 1)
    return (cands.withColumn("nn", F.row_number().over(Window.partitionBy("id").orderBy("dist", "nbr_id")))
            .filter(F.col("nn") <= k_eff).select("id", "nbr_id", "nn", "dist"))


def smote(df: DataFrame, label_col: str, features: list[str], minority: int = 1, k: int = 3,
          seed: int = 42, key_col: str = "id") -> DataFrame:
    """M7: add synthetic minority rows until the two classes balance.

    Synthetic row s (0-based) takes parent = minority row at position
    s mod n_min, one of the parent's k exact nearest minority neighbours and
    a gap u in [0, 1) — both from a hash of (seed, s) — and interpolates
    x + u (neighbour - x) on every feature. Output keeps ``df``'s columns,
    synthetic rows have a NULL key and ``synthetic`` = true. Fewer than k + 1
    minority rows raise an error, as nothing could be drawn from k neighbours.
    """
    feats = list(features)
    counts = {r[0]: r["_n"] for r in _class_rows(df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n")), label_col)}
    n_min = counts.get(minority, 0)
    n_maj = sum(v for c, v in counts.items() if c != minority)
    need = n_maj - n_min
    base = df.withColumn("synthetic", F.lit(False))
    if need > 0 and n_min <= k:
        raise ValueError(f"{n_min} rows of class {minority!r}: oversampling with {k} neighbours needs at least {k + 1}")
    if need <= 0:
        return base
    from vigilo.session import pin
    # the minority rows feed the kNN, the neighbour features and the parent positions: pin them once
    mino = pin(df.filter(F.col(label_col) == minority).select(key_col, *feats))
    nn = knn_within(mino, feats, k, key_col)
    nbr_feats = mino.select(F.col(key_col).alias("nbr_id"), F.struct(*feats).alias("nb"))
    nbrs = (nn.join(nbr_feats, "nbr_id")
            .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("nn", "nb"))).alias("nbrs")))  # <= k each
    parents = dense_positions(mino.select(F.col(key_col).alias("id"), *feats), ["id"]).join(nbrs, "id")
    parents = pin(parents)  # minority rows + positions + neighbours: cut the lineage once
    # the synthetic rows are a distributed range; each finds its parent by position, so no parent expands in one task
    syn = (df.sparkSession.range(need).select(F.col("id").alias("_s"), (F.col("id") % F.lit(n_min)).alias("pos"))
           .join(parents.withColumn("pos", F.col("pos").cast("long")), "pos"))
    pick = F.pmod(hash_bits("_s", seed=seed), F.size("nbrs")) + 1
    u = unit_hash("_s", seed=seed + 1)
    syn = syn.withColumn("_nb", F.element_at("nbrs", pick.cast("int"))["nb"]).withColumn("_u", u)
    out_cols = []
    for c in df.columns:
        if c in feats:
            out_cols.append((F.col(c).cast("double") + F.col("_u") * (F.col(f"_nb.{c}").cast("double")
                                                                      - F.col(c).cast("double"))).alias(c))
        elif c == label_col:
            out_cols.append(F.lit(minority).cast(df.schema[c].dataType).alias(c))
        else:
            out_cols.append(F.lit(None).cast(df.schema[c].dataType).alias(c))
    synthetic = syn.select(*out_cols, F.lit(True).alias("synthetic"))
    return base.select(*[F.col(c).cast("double").alias(c) if c in feats else F.col(c) for c in df.columns],
                       "synthetic").unionByName(synthetic)
