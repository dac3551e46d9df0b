"""Product codes of vectors, each part assigned by a GNAT over its codebook's entries.

A node of the tree holds a few split points; every other entry of the node
belongs to its closest split point, and for each pair of split point and child
the node stores the least and greatest distance between the point and the
child's entries. A query measures the split points and drops a whole child when
some stored range proves every entry in it further away than the best found so
far. Only strictly farther children go, with room for rounding, and candidates
are compared by integer squared distances with ties to the lower index, so
codes equal those of a full scan.

Codebooks are bounded by parameters and travel to the tasks; rows are never
shuffled. A task hands on one partial sum per part, entry and position.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import staged, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SPLITS = 4     # split points of a node
LEAF = 5       # entries that are measured without another node
#: Components are held within this: squared distances summed over 64 of them still fit 64 bits.
BOUND = 1 << 27
_ROOM = 1e-12  # relative rounding allowance of distances, some thousand times what square roots lose


class Gnat:
    """Exact nearest entry for whole batches of integer queries. ``measured`` counts the distances taken."""

    def __init__(self, points):
        import numpy as np

        self.points, self.measured = points, 0
        self.root = self._grown(np.arange(len(points)))

    def _squares(self, queries, ids):
        import numpy as np

        self.measured += len(queries) * len(ids)
        out = np.zeros((len(queries), len(ids)), np.int64)
        for d in range(self.points.shape[1]):
            gap = queries[:, d, None] - self.points[None, ids, d]
            out += gap * gap
        return out

    def _grown(self, ids):
        """(split ids, children, least, greatest); a leaf has no children. Ids ascend everywhere, for ties."""
        import numpy as np

        if len(ids) <= max(LEAF, SPLITS):
            return ids, [], None, None
        splits = [0]  # each next split point is the entry farthest from those before
        apart = self._squares(self.points[ids], ids)
        while len(splits) < SPLITS:
            far = apart[splits].min(0)
            if not far.any():
                break  # nothing but copies left
            splits.append(int(far.argmax()))
        splits.sort()
        rest = np.setdiff1d(np.arange(len(ids)), splits)
        if len(splits) == 1:
            return ids, [], None, None
        owner = apart[np.ix_(splits, rest)].argmin(0)
        distance = np.sqrt(apart.astype(float))
        groups = [rest[owner == j] for j in range(len(splits))]
        least = np.array([[distance[s, g].min() if len(g) else 0 for g in groups] for s in splits])
        greatest = np.array([[distance[s, g].max() if len(g) else 0 for g in groups] for s in splits])
        return ids[splits], [self._grown(ids[g]) if len(g) else None for g in groups], least, greatest

    def nearest(self, queries):
        """(entry, squared distance) of each query: least squared distance, ties to the lower entry."""
        import numpy as np

        best = np.full(len(queries), len(self.points), np.int64)
        least2 = np.full(len(queries), np.iinfo(np.int64).max)

        def visit(node, rows):
            ids, children, least, greatest = node
            squares = self._squares(queries[rows], ids)
            near = squares.argmin(1)  # ids ascend: the first of equals is the lowest
            found, found2 = ids[near], squares[np.arange(len(rows)), near]
            better = (found2 < least2[rows]) | ((found2 == least2[rows]) & (found < best[rows]))
            best[rows[better]], least2[rows[better]] = found[better], found2[better]
            if not children:
                return
            distance = np.sqrt(squares.astype(float))
            for closest in (True, False):  # the closest split point's child first: it narrows the radius for the others
                for j, child in enumerate(children):
                    if child is None:
                        continue
                    mine = np.flatnonzero((near == j) == closest)
                    d = distance[mine]
                    room = np.sqrt(least2[rows[mine]].astype(float))[:, None] + _ROOM * (1 + d + greatest[:, j])
                    alive = ((d - greatest[:, j] <= room) & (least[:, j] - d <= room)).all(1)
                    if alive.any():
                        visit(child, rows[mine[alive]])

        if len(queries):
            visit(self.root, np.arange(len(queries)))
        return best, least2


def _matrix(q, width: int):
    import numpy as np

    out = np.zeros((len(q), width), np.int64)
    for i, v in enumerate(q):
        out[i, :len(v)] = v
    return out


def _sums(books, parts: int, width: int):
    """Partial sums of one task: (part, entry, position, rows, total)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        trees, d = [Gnat(b) for b in books.value], width // parts
        total, count = np.zeros((parts, len(books.value[0]), d), np.int64), np.zeros((parts, len(books.value[0])), np.int64)
        for df in batches:
            m = _matrix(df["q"], width)
            for p, tree in enumerate(trees):
                own = m[:, p * d:(p + 1) * d]
                entry = tree.nearest(own)[0]
                np.add.at(total[p], entry, own)
                count[p] += np.bincount(entry, minlength=len(count[p]))
        p, e = np.nonzero(count)
        at = np.tile(np.arange(d), len(p))
        p, e = np.repeat(p, d), np.repeat(e, d)
        yield pd.DataFrame({"part": p, "entry": e, "position": at, "n": count[p, e], "total": total[p, e, at]})

    return run


def _coded(books, parts: int, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        trees, d = [Gnat(b) for b in books.value], width // parts
        for df in batches:
            m = _matrix(df["q"], width)
            found = [tree.nearest(m[:, p * d:(p + 1) * d]) for p, tree in enumerate(trees)]
            codes = np.stack([entry for entry, _ in found], 1).astype(np.uint8)
            yield pd.DataFrame({"vec_id": df["vec_id"], "label": df["label"], "code": [c.tobytes().hex() for c in codes],
                                "error": sum(error for _, error in found)})

    return run


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list]:
    """``vectors(vec_id, embedding, label, ...)`` -> (rows of vec_id, code, error, label_error, codebooks_sha256; codebooks).

    Rows whose vector is null or holds null or non-finite components are
    dropped; components become floor(256 x). Codebooks start as the parts of the
    ``entries`` smallest vec_ids (repeated ids by their vectors, null ids last);
    each round assigns every part to its nearest entry and replaces entries by
    the componentwise floor of their parts' mean, unused ones stay. code: two hex
    digits a part (so at most 256 entries); error: squared distances summed;
    label_error: error summed over rows of equal label, null labels together.
    Every row is coded, repeated ones and null ids too. Vectors are filled up
    with zeros to the widest one, rounded up to whole parts. Components beyond
    +-BOUND (x beyond half a million) are held there: their squares fit no long.
    No rows give no rows and no codebooks. Other columns are ignored.
    """
    import numpy as np

    if not 1 <= entries <= 256:
        raise ValueError("codes have two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(e, lambda x: F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), F.floor(x * 256))))
    rows = vectors.where(F.coalesce(finite, F.lit(False))).select("vec_id", "label", whole.alias("q"))
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "q").limit(entries).collect()
    widest = rows.agg(F.max(F.size("q"))).first()[0]
    if not seeds:
        none = f"vec_id {id_type}, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], none), []
    width = max(1, -(-widest // parts)) * parts
    first = _matrix([s["q"] for s in seeds], width)
    books = [first[:, p * width // parts:(p + 1) * width // parts].copy() for p in range(parts)]
    for _ in range(rounds):
        sums = rows.select("q").mapInPandas(_sums(spark.sparkContext.broadcast(books), parts, width),
                                            "part int, entry int, position int, n long, total long")
        new = sums.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        books = [b.copy() for b in books]
        for r in new.collect():  # at most entries x width rows
            books[r["part"]][r["entry"], r["position"]] = r["total"] // r["n"]
    digest = sha256(",".join(str(x) for b in books for x in np.ravel(b).tolist()).encode()).hexdigest()
    # Ids and labels pass through as text: pandas would turn longs beside a null into doubles.
    named = rows.select(F.col("vec_id").cast("string"), F.col("label").cast("string"), "q")
    coded = staged(named.mapInPandas(_coded(spark.sparkContext.broadcast(books), parts, width),
                                     "vec_id string, label string, code string, error long")
                   .select(F.col("vec_id").cast(id_type), F.col("label").cast(label_type), "code", "error"), "coded")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))), books


def op13_gnat_vector_codes(spark, sf_dir):
    return vector_codes(table(spark, sf_dir, "embeddings"))[0]


def _sql() -> str:
    near = """a{n} as (select part, id, label, v, best.entry as entry, best.d as d from (select p.part, p.id, p.label, p.v,
    min({{'d': list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, 'entry': b.entry}}) as best
  from p join b{n} b on b.part = p.part group by all))"""
    mean = """b{m} as (select b.part, b.entry, coalesce(m.v, b.v) as v from b{n} b left join (
    select part, entry, list(((s - ((s % c) + c) % c) // c)::bigint order by position) as v from (
      select part, entry, position, sum(x)::bigint as s, count(*) as c from (
        select part, entry, unnest(v) as x, unnest(range(len(v))) as position from a{n}) group by all) group by all) m
  on m.part = b.part and m.entry = b.entry)"""
    steps = [near.format(n=0), mean.format(n=0, m=1), near.format(n=1), mean.format(n=1, m=2), near.format(n=2)]
    return f"""
with k as (select row_number() over (order by vec_id) - 1 as id, vec_id, label,
    list_transform(embedding::double[], lambda x: floor(256 * x)::bigint) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select t.part, id, label, list_slice(q, 1 + t.part * (len(q) // {PARTS}), (t.part + 1) * (len(q) // {PARTS})) as v
  from k, unnest(range({PARTS})) t(part)),
b0 as (select part, id as entry, v from p where id < {ENTRIES}),
{", ".join(steps)},
h as (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as codebooks_sha256 from b2),
r as (select id, label, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from a2 group by all)
select k.vec_id, code, error, (sum(error) over (partition by r.label))::bigint as label_error, codebooks_sha256
from r join k on k.id = r.id, h
"""


ORACLE = _sql()
