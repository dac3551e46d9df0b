"""GNAT search against a full scan, and the codes against plain Python."""
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilo.llm import vector_codes
from vigilo.llm.vector_codes import Gnat, vector_codes as coded

SCHEMA = "vec_id long, embedding array<float>, label int"


def scan(points, queries):
    squares = ((queries[:, None, :].astype(object) - points[None].astype(object)) ** 2).sum(-1)
    return np.array([min(range(len(points)), key=lambda i: (row[i], i)) for row in squares]), squares.min(1).astype(np.int64)


@pytest.mark.parametrize("points", [
    np.random.default_rng(1).integers(-300, 300, (64, 4)),
    np.random.default_rng(2).integers(-2, 3, (64, 4)),                       # many ties and copies
    np.zeros((64, 4), np.int64),                                             # copies only
    np.random.default_rng(3).integers(-3, 3, (200, 1)),
    np.random.default_rng(4).integers(-(1 << 27), 1 << 27, (100, 4)),        # the largest components
    np.array([[5, 5]]), np.array([[1, 0], [0, 1], [0, -1]]),
], ids=["random", "ties", "copies", "line", "large", "one", "three"])
def test_nearest_equals_a_full_scan_with_ties_to_the_lower_entry(points):
    points, rng = points.astype(np.int64), np.random.default_rng(9)
    low, high = int(points.min()) - 3, int(points.max()) + 4
    queries = np.concatenate([rng.integers(low, high, (400, points.shape[1])), points]).astype(np.int64)
    entry, squares = Gnat(points).nearest(queries)
    want, want2 = scan(points, queries)
    assert (entry == want).all() and (squares == want2).all()


def test_a_query_halfway_between_two_entries_keeps_both_subtrees():
    """Equal distances are never pruned: the lower index wins wherever it lies in the tree."""
    points = np.array([[10 * i, 0] for i in range(64)], np.int64)[::-1].copy()
    halfway = np.array([[10 * i + 5, 0] for i in range(63)], np.int64)
    assert (Gnat(points).nearest(halfway)[0] == scan(points, halfway)[0]).all()


def test_subtrees_are_skipped():
    rng = np.random.default_rng(5)
    tree = Gnat(rng.integers(-500, 500, (64, 2)).astype(np.int64))
    queries = rng.integers(-500, 500, (5000, 2)).astype(np.int64)
    tree.measured = 0
    tree.nearest(queries)
    assert tree.measured < 0.5 * len(queries) * 64


def plain(rows, parts, entries, rounds):
    """Row by row, in whole numbers."""
    kept = [(i, [int(np.floor(256.0 * float(x))) for x in np.array(v, np.float32)], lab) for i, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    width = max(1, -(-max(len(q) for _, q, _ in kept) // parts)) * parts
    d = width // parts
    cut = [[(q + [0] * (width - len(q)))[p * d:(p + 1) * d] for p in range(parts)] for _, q, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda v, p: min(range(len(books[p])), key=lambda j: (far(v, books[p][j]), j))
    for _ in range(rounds):
        found = [[assign(c[p], p) for p in range(parts)] for c in cut]
        new = []
        for p in range(parts):
            book = []
            for j, entry in enumerate(books[p]):
                own = [c[p] for c, f in zip(cut, found) if f[p] == j]
                book.append([sum(x) // len(own) for x in zip(*own)] if own else entry)
            new.append(book)
        books = new
    codes = [[assign(c[p], p) for p in range(parts)] for c in cut]
    errors = [sum(far(c[p], books[p][f[p]]) for p in range(parts)) for c, f in zip(cut, codes)]
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    sums = {}
    for (_, _, lab), e in zip(kept, errors):
        sums[lab] = sums.get(lab, 0) + e
    return [(i, "".join(f"{x:02x}" for x in f), e, sums[lab], digest) for (i, _, lab), f, e in zip(kept, codes, errors)], books


def check(spark, rows, **how):
    out, books = coded(spark.createDataFrame(rows, SCHEMA).withColumns({"q": F.lit(1), "code": F.lit("x"), "of": F.lit(2)}), **how)
    want, want_books = plain(rows, how.get("parts", 16), how.get("entries", 64), how.get("rounds", 2))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert [np.asarray(b).tolist() for b in books] == want_books


def test_codes_equal_plain_python(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 32)], int(rng.integers(0, 4))) for i in rng.permutation(300)]
    check(spark, rows)
    check(spark, rows, parts=4, entries=10, rounds=3)


def test_whole_table_equals_a_full_scan(spark, monkeypatch):
    """Without inner nodes the tree is a full scan over all entries: same codes, errors and codebooks."""
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = [r.asDict() for r in coded(table)[0].orderBy("vec_id").collect()]
    monkeypatch.setattr(vector_codes, "LEAF", 1000)
    assert got == [r.asDict() for r in coded(table)[0].orderBy("vec_id").collect()] and len(got) == table.count()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [0.1, -0.2, 0.3, 0.4], 1), (5, [0.1, -0.2, 0.3, 0.4], 1), (5, [0.1, -0.25, 0.3, 0.4], None), (None, [0.5, 0.5, 0.5, 0.5], None),
            (2, None, 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [inf, 0.0, 0.0, 0.0], 2), (6, [None, 0.0, 0.0, 0.0], 2),
            (7, [], 2), (8, [0.25], 3), (9, [0.0, 0.0, 0.0, 0.0], 3), (10, [-0.001, 0.001, -1.0, 1.0], None)]
    check(spark, rows, parts=2, entries=3)
    check(spark, rows, parts=4, entries=64)
    check(spark, [r for r in rows if r[0] in (2, 3, 4, 6)])
    check(spark, [])


def test_hot_vectors_and_components_beyond_the_bound(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [1.0, 2.0, 3.0, 4.0], 0) for i in range(40)] + [(100 + i, [float(x) for x in rng.normal(0, 1, 4)], 1) for i in range(60)]
    check(spark, rows, parts=2, entries=64)
    out, _ = coded(spark.createDataFrame([(1, [3e38, -3e38], 0), (2, [0.0, 0.0], 0)], SCHEMA), parts=2, entries=1, rounds=0)
    assert {r["vec_id"]: r["error"] for r in out.collect()} == {1: 0, 2: 2 * (1 << 27) ** 2}
