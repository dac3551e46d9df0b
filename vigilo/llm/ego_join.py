"""Embedding near-duplicates by an epsilon grid order join.

For unit vectors cosine >= c is Euclidean distance <= eps = sqrt(2 - 2c). The
vectors are sorted by the cells (edge eps) of their leading principal
dimensions and cut into sequence blocks, some of which make a lot: one row of
the staged sequence. Lot pairs whose bounding boxes in those dimensions lie
further apart than eps are provably without links and never formed. The others
are read from the staged sequence by the task that joins them, so a vector is
shuffled once however many lots it meets. A block pair is joined recursively:
both sequences, sorted along the line between their centres, are halved, halves
too far apart are skipped. Leaves are multiplied in single precision, first in
the leading dimensions alone, where the norms of the rests give an upper bound,
then in all; what lies within rounding of the threshold is decided in double
precision. A task returns sums and a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import staged, table
from vigilo.llm.graph import components

MIN_COSINE = 0.95
DIMENSIONS = 12    # leading principal dimensions of the grid
BLOCK = 4096       # vectors per sequence block
LOT = 4 << 20      # bytes of the vectors of a lot, about
LOTS = 8           # lots of each side that a task joins, about
LEAF = 128         # vectors of a leaf, where halving stops; its product is with all leaves in reach
STRIP = 512        # vectors of a product's other side
_SLACK = 1e-9


def _staged(df: DataFrame, label: str) -> DataFrame:
    """As ``staged``; the shuffle files behind the rows go with the write, not when the driver collects its garbage, and
    Python gets its rows in batches of a few lots."""
    conf, held = df.sparkSession.conf, {}
    try:
        for key, value in (("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"),
                           ("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * LOT))):
            held[key] = conf.get(key)
            conf.set(key, value)
        return staged(df, label)
    finally:
        for key, value in held.items():
            conf.set(key, value)


def _usable(e):
    """No null, NaN or infinite component and not all of them zero; array_contains is null where a null stands."""
    infinite = F.array_contains(e, F.lit(float("inf")).cast("float")) | F.array_contains(e, F.lit(float("-inf")).cast("float"))
    low, high = F.array_min(e), F.array_max(e)
    return F.coalesce(~infinite & ~F.isnan(high) & ((low != 0) | (high != 0)), F.lit(False))


def _unit(e):
    import numpy as np

    # Scaled by the largest component first: squares of tiny or huge values neither vanish nor overflow.
    e = e / np.abs(e.astype(float)).max(1, keepdims=True)
    return e / np.sqrt((e * e).sum(1, keepdims=True))


def _matrices(column) -> Iterator:
    """Of an Arrow column of lists: the rows of each length and their values as a matrix."""
    import numpy as np

    at = column.offsets.to_numpy() - column.offsets[0].as_py()
    size, flat = np.diff(at), column.flatten().to_numpy(zero_copy_only=False)
    for width in np.unique(size):
        rows = np.flatnonzero(size == width)
        yield rows, flat.reshape(-1, width) if len(rows) == len(size) else flat[at[rows][:, None] + np.arange(width)]


def _packed(matrix):
    """An Arrow column of the matrix' rows as bytes."""
    import numpy as np
    import pyarrow as pa

    matrix = np.ascontiguousarray(matrix)
    kind = pa.binary(matrix.shape[1] * matrix.itemsize)
    return pa.FixedSizeBinaryArray.from_buffers(kind, len(matrix), [None, pa.py_buffer(matrix)]).cast(pa.binary())


def _moments(width: int):
    """Of a task's unit vectors: their number, sum and sum of outer products, in one array."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros((width + 2, width))
        for batch in batches:
            for _, e in _matrices(batch["e"]):
                u = _unit(e)
                w = u.shape[1]
                total[0, 0] += len(u)
                total[1, :w] += u.sum(0)
                total[2:2 + w, :w] += u.T @ u
        yield pa.record_batch({"moments": pa.array([total.tobytes()])})
    return run


def _both(a: bytes, b: bytes) -> bytes:
    import numpy as np

    return (np.frombuffer(a) + np.frombuffer(b)).tobytes()


def _leading(width: int) -> int:
    """Dimensions whose product and norms of the rests bound the cosine of two vectors below MIN_COSINE by five deviations
    if their directions are independent."""
    return int(((5 + (25 + 4 * (1 - MIN_COSINE) * width) ** 0.5) / 2) ** 2)


def _basis(distinct: DataFrame, width: int, n: int):
    """Orthonormal leading principal directions, width x k (fitted on all n vectors; the driver gets some width^2 numbers)."""
    import numpy as np

    k = min(max(DIMENSIONS, _leading(width)), width)
    parts = distinct.select("e").mapInArrow(_moments(width), "moments binary").rdd.map(lambda row: bytes(row[0]))
    total = np.frombuffer(parts.treeReduce(_both)).reshape(width + 2, width)
    mean = total[1] / n
    return np.ascontiguousarray(np.linalg.eigh(total[2:] / n - np.outer(mean, mean))[1][:, ::-1][:, :k])


def _placed(basis):
    """Vectors as bytes with their cells, a byte a dimension: their order is the grid order."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        eps = (2 - 2 * MIN_COSINE) ** 0.5
        for batch in batches:
            for rows, e in _matrices(batch["e"]):
                cells = np.floor(_unit(e) @ basis[:e.shape[1], :DIMENSIONS] / eps).clip(-128, 127) + 128
                yield pa.record_batch({"node": batch["node"].take(pa.array(rows)), "size": batch["size"].take(pa.array(rows)),
                                       "len": np.full(len(rows), e.shape[1], np.int32), "cells": _packed(cells.astype(np.uint8)),
                                       "v": _packed(e)})
    return run


def _cut(basis, dtype: str, rows: int):
    """Lots of a sorted partition: of ``rows`` vectors about, all of one length, a row each."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        held, length = [], None

        def lot():
            nonlocal at, held
            t = pa.Table.from_batches(held)
            v = b"".join(t["v"].to_pylist())
            p = _unit(np.frombuffer(v, dtype).reshape(len(t), -1)) @ basis[:length, :DIMENSIONS]
            at, held = at + 1, []
            return pa.record_batch({"lot": [at - 1], "len": pa.array([length], pa.int32()), "node": [t["node"].to_numpy().tobytes()],
                                    "size": [t["size"].to_numpy().tobytes()], "v": [v], "lo": [p.min(0)], "hi": [p.max(0)]})

        for batch in batches:
            lens = batch["len"].to_numpy()
            for part in np.split(np.arange(len(lens)), np.flatnonzero(np.diff(lens)) + 1):
                while len(part):
                    if held and (lens[part[0]] != length or sum(map(len, held)) >= rows * 3 // 2):
                        yield lot()
                    take = min(len(part), rows * 3 // 2 - sum(map(len, held)))
                    held.append(batch.slice(int(part[0]), take))
                    length, part = int(lens[part[0]]), part[take:]
        if held:
            yield lot()
    return run


class Block(NamedTuple):
    node: object   # numbers of the vectors
    size: object   # how often each comes
    e: object      # the vectors as they are
    x: object      # as unit vectors in single precision
    z: object      # their leading dimensions and the norm of the rest; None where that saves nothing
    box: object    # low and high in the dimensions of the grid


def _block(node, size, e, basis) -> Block:
    import numpy as np

    u = _unit(e)
    p = u @ basis[:e.shape[1]]
    k, z = min(_leading(len(basis)), basis.shape[1]), None
    if 4 * k <= 3 * e.shape[1]:
        rest = p[:, :k] @ basis[:, :k].T
        rest[:, :e.shape[1]] -= u
        z = np.column_stack([p[:, :k], np.sqrt((rest * rest).sum(1))]).astype(np.float32)
    p = p[:, :DIMENSIONS]
    return Block(node, size, e, u.astype(np.float32), z, (p.min(0), p.max(0)) if len(p) else None)


def _blocks(node: bytes, size: bytes, v: bytes, dtype: str, basis, rows: int) -> list:
    """The blocks of a lot."""
    import numpy as np

    node, size = np.frombuffer(node, np.int64), np.frombuffer(size, np.int64)
    e = np.frombuffer(v, dtype).reshape(len(node), -1)
    at = np.linspace(0, len(node), -(-len(node) // rows) + 1).astype(int)
    return [_block(node[s:t], size[s:t], e[s:t], basis) for s, t in zip(at[:-1], at[1:])]


def _boxes(p):
    """Boxes of a sequence's halves, from the whole one down to its leaves: [(low, high)]."""
    import numpy as np

    at = np.arange(0, len(p), LEAF)
    levels = [(np.minimum.reduceat(p, at), np.maximum.reduceat(p, at))]
    while len(levels[-1][0]) > 1:
        low, high = levels[-1]
        at = np.arange(0, len(low), 2)
        levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
    return levels[::-1]


def _near_leaves(left, right, same: bool):
    """Pairs of leaves that may hold links: both sequences are halved level by level, halves too far apart are skipped
    with all that is in them. Of a sequence and itself every pair once."""
    import numpy as np

    eps2 = 2 - 2 * MIN_COSINE + _SLACK
    i = j = np.zeros(1, np.int64)
    for level in range(max(len(left), len(right))):
        (alo, ahi), (blo, bhi) = left[min(level, len(left) - 1)], right[min(level, len(right) - 1)]
        if level and level < len(left):
            i, j = (2 * i[:, None] + [0, 1]).ravel(), np.repeat(j, 2)
        if level and level < len(right):
            i, j = np.repeat(i, 2), (2 * j[:, None] + [0, 1]).ravel()
        there = (i < len(alo)) & (j < len(blo)) & (~np.bool_(same) | (i <= j))
        i, j = i[there], j[there]
        gap = np.maximum(0, np.maximum(alo[i] - bhi[j], blo[j] - ahi[i]))
        near = (gap * gap).sum(1) <= eps2
        i, j = i[near], j[near]
    return i, j


def _runs(keys, values):
    """Sorted keys, each once, and the values of each."""
    import numpy as np

    at = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[at], np.split(values, at[1:])


def _classes(u, v):
    """The nodes of the edges (u, v), sorted, and the smallest node of each one's class."""
    import numpy as np

    nodes, k = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v, low = k[:len(u)], k[len(u):], np.arange(len(nodes))
    while True:
        a, b = low[u], low[v]
        if (a == b).all():
            return nodes, nodes[low]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low != low[low]).any():
            low = low[low]


def _summed(parts: list):
    """Rows (node, links, root) as one array: a row per node, its links summed, its root the smallest node of its class."""
    import numpy as np

    node, links, root = np.concatenate(parts, axis=1)
    _, low = _classes(node, root)  # every root has a row of its own
    nodes, k = np.unique(node, return_inverse=True)
    total = np.zeros(len(nodes), np.int64)
    np.add.at(total, k, links)
    return np.stack([nodes, total, low])


def _linked(basis):
    def block(df) -> Block:
        import numpy as np

        return _block(df["node"].to_numpy(), df["size"].to_numpy(), np.frombuffer(b"".join(df["v"]), "<f8").reshape(len(df), -1), basis)

    def run(key, left, right) -> pd.DataFrame:
        import numpy as np

        none = pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
        same = key[0] == key[1]
        left, right = (side if isinstance(side, Block) else block(side) if len(side) else None for side in (left, right))
        if left is None or right is None:
            return none
        right = left if same else right
        width = left.x.shape[1]
        blur = np.float32(1.2e-7 * (len(basis) + 8))  # more than single precision rounds a product or a projection
        # The line between the centres gives the order: along it the sequences lie apart.
        line = left.x.mean(0, dtype=float) - right.x.mean(0, dtype=float)
        line = line / np.linalg.norm(line) if np.linalg.norm(line) > 1e-6 else basis[:width, 0]
        px, py = left.x @ line.astype(np.float32), right.x @ line.astype(np.float32)
        ox, oy = np.argsort(px, kind="stable"), np.argsort(py, kind="stable")
        wide = lambda p: [(low - blur, high + blur) for low, high in _boxes(p[:, None])]
        i, j = _near_leaves(wide(px[ox]), wide(py[oy]), same)
        if not len(i):
            return none
        x, y = (left.x[ox], right.x[oy]) if left.z is None else (left.z[ox], right.z[oy])
        cx, cy = left.size[ox].astype(float), right.size[oy].astype(float)
        gx, gy = np.zeros(len(x)), np.zeros(len(y))
        off = 0 if same else len(x)
        edges = []

        def join(a, b, own):
            """Links of the vectors a with the vectors b, both ranges; own: of a sequence with itself."""
            cosine = x[a.start:a.stop] @ y[b.start:b.stop].T
            if cosine.max() < MIN_COSINE - blur:
                return
            a, b = np.arange(a.start, a.stop), np.arange(b.start, b.stop)
            if left.z is not None:
                above = cosine >= MIN_COSINE - blur
                a, b = a[above.any(1)], b[above.any(0)]
                cosine = left.x[ox[a]] @ right.x[oy[b]].T
            hit = cosine >= MIN_COSINE + blur
            r, s = np.nonzero((cosine >= MIN_COSINE - blur) & ~hit)
            for k in range(0, len(r), 1 << 14):
                m, n = r[k:k + (1 << 14)], s[k:k + (1 << 14)]
                hit[m, n] = (_unit(left.e[ox[a[m]]]) * _unit(right.e[oy[b[n]]])).sum(1) >= MIN_COSINE
            if same:
                hit &= a[:, None] != b[None, :]
            r, s = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
            if not len(r):
                return
            hit, a, b = hit[np.ix_(r, s)], a[r], b[s]
            gx[a] += hit @ cy[b]
            if not own:
                gy[b] += cx[a] @ hit
            # Least label over the hits until nothing moves: the links' classes within this product.
            la, lb = np.arange(len(a)), np.full(len(b), len(a))
            while True:
                lb = np.minimum(lb, np.where(hit, la[:, None], len(a)).min(0))
                new = np.minimum(la, np.where(hit, lb[None, :], len(a)).min(1))
                if (new == la).all():
                    break
                la = new
            edges.extend([(a, a[la]), (off + b, a[lb])])

        order = np.lexsort((j, i))
        for leaf, others in zip(*_runs(i[order], j[order])):  # along a line the others stand together
            a = range(leaf * LEAF, min(len(x), (leaf + 1) * LEAF))
            at, end = int(others[0]) * LEAF, min(len(y), (int(others[-1]) + 1) * LEAF)
            if same and others[0] == leaf:
                join(a, a, True)
                at = a.stop
            for s in range(at, end, STRIP):
                join(a, range(s, min(end, s + STRIP)), False)
        if not edges:
            return none
        nodes, links = (left.node[ox], gx + gy) if same else (np.concatenate([left.node[ox], right.node[oy]]), np.concatenate([gx, gy]))
        u, v = (nodes[np.concatenate(k)] for k in zip(*edges))
        on = np.flatnonzero(links)
        on = on[np.argsort(nodes[on])]
        return pd.DataFrame({"node": nodes[on], "links": links[on].astype(np.int64), "root": _classes(u, v)[1]})

    return run


def _lots_linked(basis, dtype: str, rows: int, most: int):
    """Of rows with two lots each: the links of their vectors, summed over the task's rows. ``most`` lots stay unpacked."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        reach = 2 - 2 * MIN_COSINE + _SLACK
        linked, held, found, n = _linked(basis), {}, [], 0
        for batch in batches:
            for row in range(len(batch)):
                sides = []
                for side in "ab":
                    lot = batch[f"{side}_lot"][row].as_py()
                    if lot not in held:
                        while len(held) >= most:
                            held.pop(next(iter(held)))
                        held[lot] = _blocks(*(batch[f"{side}_{c}"][row].as_py() for c in ("node", "size", "v")), dtype, basis, rows)
                    held[lot] = held.pop(lot)  # the last used go last
                    sides.append((lot, held[lot]))
                (a, left), (b, right) = sides
                for i, one in enumerate(left):
                    for j, other in enumerate(right):
                        gap = np.maximum(0, np.maximum(one.box[0] - other.box[1], other.box[0] - one.box[1]))
                        if a == b and j < i or gap @ gap > reach:
                            continue
                        out = linked(((a, i), (b, j)), one, other)
                        if len(out):
                            found.append(out.to_numpy().T)
                            n += len(out)
                if n > 1 << 21:
                    found = [_summed(found)]
                    n = 0
        if found:
            node, links, root = _summed(found)
            for s in range(0, len(node), 1 << 16):
                yield pa.record_batch({k: np.ascontiguousarray(c[s:s + (1 << 16)]) for k, c in (("node", node), ("links", links), ("root", root))})
    return run


def _identity(e):
    """128 bits that stand for a vector, so that no further step has to move it."""
    return [F.xxhash64(F.lit(seed), e).alias(f"h{seed}") for seed in (1, 2)]


def near_vectors(vectors: DataFrame) -> DataFrame:
    """``vectors(vec_id, embedding, ...)`` -> one row per input row: vec_id, n_links, component_id, kept.

    Two vectors are linked at cosine >= MIN_COSINE; null or zero vectors and those
    with null or non-finite components link with nothing, and neither do vectors
    of different length. Equal vectors are one node with a multiplicity (so a hot
    vector costs nothing); repeated rows count as other vectors. component_id is
    the smallest vec_id reachable; a null vec_id never names a class while another
    id is there and carries kept = false. Other columns are ignored; no rows give
    no rows.
    """
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    dtype = "<f4" if single else "<f8"
    rows = vectors.select("vec_id", F.col("embedding").cast("array<float>" if single else "array<double>").alias("e"))
    good = rows.where(_usable(F.col("e")))
    distinct = _staged(good.groupBy("e").agg(F.count("*").alias("size"), F.min("vec_id").alias("first"))
                      .select(F.monotonically_increasing_id().alias("node"), "e", "size", "first", *_identity(F.col("e"))), "distinct")
    top = distinct.agg(F.max(F.size("e")).alias("w"), F.count("*").alias("n")).first()
    alone = (F.col("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
             F.col("vec_id").isNotNull().alias("kept"))
    if not top["n"]:
        return rows.select(*alone)
    basis = _basis(distinct, top["w"], top["n"])
    k = min(DIMENSIONS, basis.shape[1])
    order = ["len", "cells", "node"]
    size = min(max(1, LOT // (top["w"] * (4 if single else 8))), max(BLOCK, top["n"] // 12))
    many = -(-top["n"] // size)
    placed = distinct.select("node", "size", "e").mapInArrow(_placed(basis), "node long, size long, len int, cells binary, v binary")
    lots = _staged(placed.repartitionByRange(many, *order).sortWithinPartitions(*order)
                  .mapInArrow(_cut(basis, dtype, size), "lot long, len int, node binary, size binary, v binary, lo array<double>, hi array<double>"),
                  "lots")

    # Each task of the product reads the lots of its two parts: no vector is shuffled or kept once more for a pair.
    eps = (2 - 2 * MIN_COSINE) ** 0.5
    parts = max(min(many, 12), -(-many // LOTS))
    a, b = (lots.coalesce(parts).select(*[F.col(c).alias(f"{side}_{c}") for c in lots.columns]) for side in "ab")
    gaps = [F.greatest(F.lit(0.0), F.col("a_lo")[j] - F.col("b_hi")[j], F.col("b_lo")[j] - F.col("a_hi")[j]) for j in range(k)]
    near = sum((g * g for g in gaps), F.lit(0.0)) <= eps * eps + _SLACK
    even = lambda c: F.shiftright(c, 32) + F.col(c)
    once = (F.col("a_lot") == F.col("b_lot")) | ((F.col("a_lot") < F.col("b_lot")) == (F.pmod(even("a_lot") + even("b_lot"), F.lit(2)) == 0))
    pairs = (a.hint("shuffle_replicate_nl").join(b, (F.col("a_len") == F.col("b_len")) & once & near)
             .select(*[f"{side}_{c}" for side in "ab" for c in ("lot", "node", "size", "v")]))
    found = _staged(pairs.mapInArrow(_lots_linked(basis, dtype, BLOCK, LOTS + 1), "node long, links long, root long"), "found")

    classes = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = classes.join(links, "node").join(distinct.select("node", "first"), "node")
    names = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = linked.join(names, "root").select("node", "component_id", "links")
    named = (distinct.select("node", "h1", "h2", "size", "first").join(linked, "node", "left")
             .select("h1", "h2", F.coalesce("component_id", "first").alias("component_id"),
                     (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return (good.select("vec_id", *_identity(F.col("e"))).join(named, ["h1", "h2"]).select("vec_id", "n_links", "component_id", kept)
            .unionByName(rows.where(~_usable(F.col("e"))).select(*alone)))


def op7_epsilon_grid_order(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
g as (select vec_id, e from v where e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
  and len(list_filter(e, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from g a join g b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  and list_cosine_similarity(a.e, b.e) >= 0.95),
reach(id, r) as (select vec_id, vec_id from v union select l.b, reach.r from reach join l on l.a = reach.id),
c as (select id, min(r) as component_id from reach group by id),
n as (select a, count(*) as n from l group by a)
select c.id as vec_id, coalesce(n.n, 0)::bigint as n_links, component_id, c.id = component_id as kept
from c left join n on n.a = c.id
"""
