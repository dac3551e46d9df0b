"""M7: exact k nearest neighbours among distinct vectors, by the cells of a k-d tree.

A sample steers: its median cuts make a tree of cells (at most SAMPLE_ROWS /
``window``), every row goes to its cell. A row's k nearest inside its own cell
bound the distance of its k nearest of all; it then visits only those other cells
whose box of values lies within that bound, each once. Both steps are one job
over all rows, however they lie, so the plan has the same few stages at any size;
the driver holds the sampled rows, the cells' boxes and counts. A bad sample
costs time, never a neighbour: boxes are taken from all rows, and a box is at
least as near as each of its rows, by the same operations in the same order.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled rows that steer the cells: every SAMPLE_STEP-th row, and not more than about SAMPLE_ROWS.
SAMPLE_ROWS, SAMPLE_STEP = 20_000, 8
#: Visiting rows that one task takes for a cell; a cell with more visitors is dealt to several tasks.
VISITORS = 20_000
#: Rows of a block that is searched whole, and distances held at once.
BLOCK_ROWS, HELD = 512, 1 << 21
_NONE = 1 << 62  # the code of an empty place in a list of neighbours, behind all others


def _tree(x, most: int):
    """Median cuts along the direction of largest variance until a part holds ``most`` rows: [(dim, cut, left, right) or leaf number]."""
    import numpy as np

    nodes, leaves, open_parts = [None], 0, [(0, np.arange(len(x)))]
    while open_parts:
        at, rows = open_parts.pop()
        part, cut = x[rows], None
        if len(rows) > most:
            for j in np.argsort(-np.nan_to_num(part.var(0)), kind="stable"):
                v = np.sort(part[:, j])
                if v[0] < v[-1]:
                    middle = v[(len(v) - 1) // 2]
                    cut = j, middle if middle < v[-1] else v[v < v[-1]][-1]
                    break
        if cut is None:
            nodes[at] = leaves
            leaves += 1
            continue
        low = part[:, cut[0]] <= cut[1]
        nodes[at] = int(cut[0]), float(cut[1]), len(nodes), len(nodes) + 1
        open_parts += [(len(nodes), rows[low]), (len(nodes) + 1, rows[~low])]
        nodes += [None, None]
    return nodes


def _leaves(nodes, x):
    """Leaf number of every row."""
    import numpy as np

    out, open_parts = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
    while open_parts:
        at, rows = open_parts.pop()
        if isinstance(nodes[at], int):
            out[rows] = nodes[at]
            continue
        j, cut, left, right = nodes[at]
        low = x[rows, j] <= cut
        open_parts += [p for p in ((left, rows[low]), (right, rows[~low])) if len(p[1])]
    return out


def _far(x, low, high):
    """Distance of every row to a box: no row inside the box is nearer (NaN: unknown)."""
    import numpy as np

    sq = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = np.maximum(np.maximum(low[j] - x[:, j], x[:, j] - high[j]), 0.0)
        sq += d * d
    return np.sqrt(sq)


def _first(d, c, k: int):
    """The first k of every row's places by (distance, code)."""
    import numpy as np

    order = np.lexsort((c, d), axis=1)[:, :k]
    return np.take_along_axis(d, order, 1), np.take_along_axis(c, order, 1)


def _whole(q, q_code, p, p_code, k: int):
    """The k nearest of ``p`` (in the order of their codes) for every row of ``q`` other than itself, from all distances."""
    import numpy as np

    dist, code = np.full((len(q), k), np.nan), np.full((len(q), k), _NONE)
    step = max(1, HELD // max(1, len(p)))
    for s in range(0, len(q), step):
        at = q[s:s + step]
        sq = np.zeros((len(at), len(p)))
        for j in range(p.shape[1]):
            d = at[:, j, None] - p[None, :, j]
            sq += d * d
        d = np.sqrt(sq)
        order = np.argsort(d, axis=1, kind="stable")[:, :k + 1]
        d, c = np.take_along_axis(d, order, 1), p_code[order]
        own = c == q_code[s:s + step, None]
        d[own], c[own] = np.nan, _NONE
        d, c = _first(d, c, k)
        dist[s:s + step, :d.shape[1]], code[s:s + step, :c.shape[1]] = d, c
    return dist, code


def _k_nearest(q, q_code, p, p_code, k: int, limit):
    """As :func:`_whole`, but blocks of ``p`` farther than ``limit`` or the k-th neighbour so far are left out."""
    import numpy as np

    order = np.argsort(p_code)
    p, p_code = p[order], p_code[order]
    if len(p) <= BLOCK_ROWS:
        return _whole(q, q_code, p, p_code, k)
    dist, code = np.full((len(q), k), np.nan), np.full((len(q), k), _NONE)
    leaf = _leaves(_tree(p, BLOCK_ROWS // 2), p)
    blocks = np.split(np.argsort(leaf, kind="stable"), np.flatnonzero(np.diff(np.sort(leaf))) + 1)
    far = np.stack([_far(q, p[b].min(0), p[b].max(0)) for b in blocks], 1)
    nearest = np.argmin(np.where(np.isnan(far), -1.0, far), 1)
    for first in (True, False):
        for i, b in enumerate(blocks):
            kth = np.where(code[:, -1] == _NONE, limit, np.fmin(limit, dist[:, -1]))
            rows = np.flatnonzero((nearest == i) if first else (nearest != i) & ~(far[:, i] > kth))
            if len(rows):
                d, c = _whole(q[rows], q_code[rows], p[b], p_code[b], k)
                dist[rows], code[rows] = _first(np.hstack([dist[rows], d]), np.hstack([code[rows], c]), k)
    return dist, code


def _matrix(column):
    import numpy as np

    return np.stack(column.to_numpy()).astype(float)


def _column(lists) -> pd.Series:
    return pd.Series(list(lists), dtype=object)


def _lists(dist, code, ids):
    """Columns ``nbr`` and ``dist``: every row's neighbours, without the empty places."""
    found = [c != _NONE for c in code]
    return {"nbr": _column(list(ids[c[f]]) for c, f in zip(code, found)), "dist": _column(list(d[f]) for d, f in zip(dist, found))}


def _at_home(k: int, cells, low, high):
    def run(df: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        x = _matrix(df["x"])
        codes, ids = pd.factorize(df["id"], sort=True)
        asks = df["ask"].to_numpy(bool)
        q = x[asks]
        dist, code = _k_nearest(q, codes[asks], x, codes, k, np.full(len(q), np.inf))
        kth = np.where(code[:, -1] == _NONE, np.inf, dist[:, -1])
        visits = [[] for _ in range(len(q))]
        for i, cell in enumerate(cells):
            if cell != df["cell"].iat[0]:
                for r in np.flatnonzero(~(_far(q, low[i], high[i]) > kth)):
                    visits[r].append(cell)
        return pd.DataFrame({"id": df["id"].to_numpy()[asks], "x": _column(q), "kth": kth, **_lists(dist, code, np.asarray(ids)),
                             "visits": _column(visits)})

    return run


def _away(k: int):
    def run(guests: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        if guests.empty or rows.empty:
            return pd.DataFrame({"id": guests["id"][:0], "nbr": _column([]), "dist": _column([])})
        codes, ids = pd.factorize(pd.concat([guests["id"], rows["id"]], ignore_index=True), sort=True)
        dist, code = _k_nearest(_matrix(guests["x"]), codes[:len(guests)], _matrix(rows["x"]), codes[len(guests):], k, guests["kth"].to_numpy())
        return pd.DataFrame({"id": guests["id"], **_lists(dist, code, np.asarray(ids))})

    return run


def nearest_vectors(df: DataFrame, features: list[str], k: int, window: int = 32) -> DataFrame:
    """The k nearest other rows (Euclidean, ties by id) of each row with ``ask`` true: (id, nbr_id, dist), of candidates
    that hold them: the caller ranks and keeps k.

    ``df`` has id, ``ask`` and the features; vectors are pairwise distinct, rows with a null feature have no distance and
    take no part. ``window`` is the number of sampled rows in a cell.
    """
    import numpy as np
    from vigilo.session import pin

    spark, key = df.sparkSession, df.schema["id"].dataType
    vectors = df.dropna(subset=["id", *features]).select("id", "ask", F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    vectors = pin(vectors)
    step = max(SAMPLE_STEP, -(-vectors.count() // SAMPLE_ROWS))
    sample = vectors.where(F.pmod(F.xxhash64("x"), F.lit(step)) == 0).select("x").collect()
    nodes = _tree(np.array([r["x"] for r in sample], float).reshape(len(sample), len(features)), window)
    cell_of = F.pandas_udf(lambda x: pd.Series(_leaves(nodes, _matrix(x))), "long")
    placed = pin(vectors.withColumn("cell", cell_of("x")))
    extent = [f(F.get("x", F.lit(j))).alias(f"{n}{j}") for j in range(len(features)) for f, n in ((F.min, "low"), (F.max, "high"))]
    boxes = placed.groupBy("cell").agg(*extent).collect()  # a row per cell
    low, high = ([[r[f"{n}{j}"] for j in range(len(features))] for r in boxes] for n in ("low", "high"))
    lists = [T.StructField("nbr", T.ArrayType(key)), T.StructField("dist", T.ArrayType(T.DoubleType()))]
    home = T.StructType([T.StructField("id", key), T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("kth", T.DoubleType()),
                         *lists, T.StructField("visits", T.ArrayType(T.LongType()))])
    found = pin(placed.groupBy("cell").applyInPandas(_at_home(k, [r["cell"] for r in boxes], low, high), home))
    guests = found.select("id", "x", "kth", F.explode("visits").alias("cell"))
    parts = guests.groupBy("cell").count().select("cell", F.ceil(F.col("count") / VISITORS).alias("parts"))
    parts = F.broadcast(spark.createDataFrame(parts.collect(), "cell long, parts long"))  # a row per cell
    guests = guests.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    hosts = placed.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    away = guests.groupBy("cell", "part").cogroup(hosts.select("cell", "part", "id", "x").groupBy("cell", "part"))
    away = away.applyInPandas(_away(k), T.StructType([T.StructField("id", key), *lists]))
    each = F.inline(F.arrays_zip(F.col("nbr").alias("nbr_id"), "dist"))
    return found.select("id", each).unionByName(away.select("id", each))
