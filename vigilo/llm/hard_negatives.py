"""Hard negatives by slot-decomposed selection.

Each positive of an anchor asks for the best rows of other labels whose score
lies in a window below the positive's own. The windows of one anchor overlap,
but their upper limits cut the score axis into disjoint slots, and a negative
lies in exactly one. Combiners keep the first k of each slot (inside a block of
rows, then across blocks), so a task hands on at most k rows per anchor and
slot whatever it read. Descending suffix merges then answer every window: the
first k below a positive's limit are the first k of its slot and all lower
ones, and those under its lower limit are cut off the end.

Rows are dealt by label into groups, anchors into chunks, and every (group,
chunk) cell is one exact integer matrix product. Memory is bounded by a cell,
whatever a label's share; a lost task repeats alone.
"""

from __future__ import annotations

from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilo.llm.common import staged, table

POSITIVES = 5
NEGATIVES = 5
ANCHOR_EVERY = 100
#: A window is LOW_PARTS / HIGH_PARTS of the positive's score up to the score itself.
LOW_PARTS, HIGH_PARTS = 4, 5
#: Vectors of a group (sized between these by the table) and anchors of a chunk; rows and anchors of one product.
GROUP_LEAST, GROUP_MOST, CHUNK = 2_048, 131_072, 65_536
_ROWS, _ANCHORS = 2_048, 512

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame) -> DataFrame:
    """Rows with an id, a label and a finite vector as (vec_id, label, q): moved labels and integer components."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), moved.cast("long").alias("label"),
                    F.transform(e, lambda x: F.floor(x * 256)).alias("q")))


def _matrix(q, width: int):
    import numpy as np

    out = np.zeros((len(q), width), np.int64)
    for i, v in enumerate(q):
        out[i, :len(v)] = v
    return out


def _product(x, y, width: int, most: int):
    """Exact integer inner products (``most`` bounds the components); wide components are multiplied in two halves."""
    import numpy as np

    if most * most * width < 1 << 53:
        return (x.astype(float) @ y.T.astype(float)).astype(np.int64)
    xh, xl, yh, yl = (p.astype(float) for p in (x >> 14, x & 0x3FFF, y >> 14, y & 0x3FFF))
    whole = lambda a, b: (a @ b.T).astype(np.int64)
    return (whole(xh, yh) << 28) + ((whole(xh, yl) + whole(xl, yh)) << 14) + whole(xl, yl)


def _first(k: int, keys, scores, at):
    """Places of the first k by (score descending, place) within each key."""
    import numpy as np

    order = np.lexsort((at, -scores, keys))
    ranked = keys[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < k]


def _selected(pick, k: int, slots: int, width: int, most: int):
    """One cell: the first k rows per anchor and slot. ``pick(scores, same, limits)`` -> (anchor, row, slot) of candidates."""
    def run(key, rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        none = pd.DataFrame({"a": [], "slot": [], "score": [], "vec_id": []}).astype("int64")
        if rows.empty or anchors.empty:
            return none
        rows = rows.sort_values("vec_id", ignore_index=True)  # places in the cell then order equal scores
        ids, labels, y = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["q"], width)
        out = []
        for s in range(0, len(anchors), _ANCHORS):
            part = anchors.iloc[s:s + _ANCHORS]
            x, own = _matrix(part["q"], width), part["label"].to_numpy()
            limits = np.array(part["limits"].tolist(), np.int64).reshape(len(part), -1) if "limits" in part else None
            best = (np.zeros(0, np.int64),) * 3  # (anchor * slots + slot, score, place)
            least = np.full(len(part) * slots, np.iinfo(np.int64).min)  # of full lists; later places lose ties
            for t in range(0, len(rows), _ROWS):
                scores = _product(x, y[t:t + _ROWS], width, most)
                a, b, slot = pick(scores, own[:, None] == labels[None, t:t + _ROWS], limits)
                keys, found = a * slots + slot, scores[a, b]
                better = found > least[keys]
                keys, found, at = (np.concatenate(p) for p in zip(best, (keys[better], found[better], b[better] + t)))
                if not len(keys):
                    continue
                keep = _first(k, keys, found, at)
                best = keys[keep], found[keep], at[keep]
                full = np.flatnonzero(np.bincount(best[0], minlength=len(least)) == k)
                low = np.full(len(least), np.iinfo(np.int64).max)
                np.minimum.at(low, best[0], best[1])
                least[full] = low[full]
            keys, found, at = best
            out.append(pd.DataFrame({"a": part["a"].to_numpy()[keys // slots], "slot": keys % slots, "score": found, "vec_id": ids[at]}))
        return pd.concat(out, ignore_index=True)

    return run


def _same_label(scores, same, limits):
    """All rows of the anchor's label that can be among the first: the best of each anchor in this product, with ties by place."""
    import numpy as np

    k = POSITIVES + 1
    held = np.where(same, scores, np.iinfo(np.int64).min)
    if held.shape[1] > k:
        level = np.partition(held, held.shape[1] - k, axis=1)[:, -k][:, None]
        tied = held == level
        same = same & ((held > level) | (tied & (np.cumsum(tied, axis=1) <= k)))
    a, b = np.nonzero(same)
    return a, b, np.zeros(len(a), np.int64)


def _in_slots(scores, same, limits):
    """Rows of other labels inside some window, with the slot they lie in: the number of limits at or above the score, less one."""
    import numpy as np

    # Unused places hold -1; a window below zero is empty, so real limits are never negative.
    top = limits[:, :1]
    floor = np.where(limits >= 0, -(-LOW_PARTS * limits // HIGH_PARTS), top + 1).min(1, keepdims=True)
    a, b = np.nonzero(~same & (scores <= top) & (scores >= floor))
    above = (limits[a] >= scores[a, b][:, None]) & (limits[a] >= 0)
    slot = above.sum(1) - 1
    inside = HIGH_PARTS * scores[a, b] >= LOW_PARTS * limits[a, slot]
    return a[inside], b[inside], slot[inside]


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k per key across cells; the rank limit also runs before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """``vectors(vec_id, embedding, label, ...)`` -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id or label, a null vector or a null or non-finite component
    take no part. Labels of rows whose vec_id is divisible by 7 become
    (label + 1) % 10 first; components become floor(256 x). Scores are integer inner
    products, equal scores go by the smaller id. Anchors are the rows whose
    vec_id is divisible by ANCHOR_EVERY; an anchor without another row of its
    label, or whose windows hold no row, gives no rows. Repeated rows are rows of
    their own: each may be an anchor, a positive or a negative. Shorter vectors
    count as filled up with zeros, empty ones score 0. Components so large that
    a score could leave 64 bits are held at that bound (some 500,000 for 64 of
    them). Other columns are ignored.
    """
    rows = usable(vectors)
    top = rows.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("width")).first()
    if not top["n"]:
        return rows.sparkSession.createDataFrame([], RESULT)
    width = max(1, top["width"])
    bound = isqrt((1 << 60) // width)
    held = F.transform("q", lambda x: F.greatest(F.lit(-bound), F.least(F.lit(bound), x)))
    group = max(GROUP_LEAST, min(GROUP_MOST, top["n"] // 64))
    rows = staged(rows.withColumns({"q": held, "deal": F.rand(7)})
                  .repartitionByRange(-(-top["n"] // group), "label", "deal")
                  .select("vec_id", "label", "q", F.spark_partition_id().alias("grp")), "rows")
    anchors = (rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).groupBy("vec_id", "label", "q").agg(F.count("*").alias("copies")))
    anchors = staged(anchors.withColumn("a", F.monotonically_increasing_id()), "anchors")
    size = F.coalesce(F.array_max(F.transform("q", F.abs)), F.lit(0))
    groups = rows.groupBy("grp").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max(size).alias("most"))
    most = groups.agg(F.max("most")).first()[0]
    chunks = max(1, -(-anchors.count() // CHUNK))
    cells = groups.select("grp", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    in_cells = rows.join(cells.select("grp", "chunk"), "grp").select("grp", "chunk", "vec_id", "label", "q").groupBy("grp", "chunk")
    chunk = F.pmod(F.xxhash64("a"), F.lit(chunks)).cast("int")
    found = "a long, slot long, score long, vec_id long"

    def met(asking: DataFrame, meets, selected) -> DataFrame:
        other = asking.withColumn("chunk", chunk).join(cells, "chunk").where(meets)
        other = other.select(F.col("grp").alias("to_grp"), F.col("chunk").alias("to_chunk"), *asking.columns)
        return in_cells.cogroup(other.groupBy("to_grp", "to_chunk")).applyInPandas(selected, found)

    # Positives: an anchor only meets groups that hold its label; one copy of itself is taken out of its first six.
    near = met(anchors.select("a", "label", "q"), F.col("label").between(F.col("lo"), F.col("hi")),
               _selected(_same_label, POSITIVES + 1, 1, width, most))
    listed = (_ranked(near, ["a"], POSITIVES + 1).groupBy("a")
              .agg(F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("first")))
    norm = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x * x)
    first = F.transform("first", lambda p: F.struct(p["score"].alias("score"), p["vec_id"].alias("vec_id")))
    itself = F.array_position(F.col("others"), F.struct(norm.alias("score"), F.col("vec_id")))
    positives = F.slice(F.filter("others", lambda p, i: i + 1 != F.col("itself")), 1, POSITIVES)
    limits = F.transform(F.sequence(F.lit(1), F.lit(POSITIVES)),
                         lambda j: F.greatest(F.lit(-1), F.coalesce(F.try_element_at(F.col("positives")["score"], j), F.lit(-1))))
    asking = staged(anchors.join(listed, "a").withColumn("others", first).withColumn("itself", itself)
                    .withColumn("positives", positives).withColumn("limits", limits)
                    .where(F.col("limits")[0] >= 0).select("a", "vec_id", "label", "q", "copies", "positives", "limits"), "asking")

    # Negatives: an anchor meets every group that holds another label.
    negatives = met(asking.select("a", "label", "q", "limits"), ~((F.col("lo") == F.col("label")) & (F.col("hi") == F.col("label"))),
                    _selected(_in_slots, NEGATIVES, POSITIVES, width, most))
    slots = (_ranked(negatives, ["a", "slot"], NEGATIVES).groupBy("a")
             .agg(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "vec_id")).alias("kept")))

    def merged(acc, j):  # from the lowest slot up: what lies below a limit, first k
        own = F.transform(F.filter("kept", lambda n: n["slot"] == j), lambda n: F.struct(n["down"], n["vec_id"]))
        best = F.slice(F.array_sort(F.concat(own, acc["best"])), 1, NEGATIVES)
        return F.struct(best.alias("best"), F.concat(acc["windows"], F.array(F.struct(j.alias("j"), best.alias("best")))).alias("windows"))

    pair = "array<struct<down:bigint,vec_id:bigint>>"
    start = F.struct(F.array().cast(pair).alias("best"), F.array().cast(f"array<struct<j:int,best:{pair}>>").alias("windows"))
    lowest_first = F.transform(F.sequence(F.lit(POSITIVES - 1), F.lit(0), F.lit(-1)), lambda j: j.cast("int"))
    windows = F.aggregate(lowest_first, start, merged, lambda acc: acc["windows"])
    asked = (asking.join(slots, "a").withColumn("window", F.explode(windows))
             .withColumn("positive", F.try_element_at("positives", F.col("window")["j"] + 1)))
    inside = F.filter(F.col("window")["best"], lambda n: -n["down"] * HIGH_PARTS >= F.col("positive")["score"] * LOW_PARTS)
    return (asked.where(F.col("positive").isNotNull() & (F.col("limits")[F.col("window")["j"]] >= 0))
            .select("vec_id", "copies", "positive", F.posexplode(inside).alias("place", "negative"))
            .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select(F.col("vec_id").alias("anchor_id"), F.col("positive")["vec_id"].alias("positive_id"),
                    (F.col("place") + 1).cast("int").alias("rank"), F.col("negative")["vec_id"].alias("negative_id"),
                    F.col("positive")["score"].alias("positive_score"), (-F.col("negative")["down"]).alias("negative_score")))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding::double[], lambda x: floor(256 * x)) as q from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, other as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select p.anchor_id, positive_id,
  (row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.other))::int as rank,
  s.other as negative_id, positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same
  and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score
qualify rank <= 5
"""
