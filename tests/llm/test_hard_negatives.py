"""Slot-decomposed hard negatives against plain Python over all pairs."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilo.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and np.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256.0 * float(x))) for x in np.array(v, np.float32)]))
    out = []
    for k, (i, label, q) in enumerate(kept):
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(q, p)), j, lab == label) for m, (j, lab, p) in enumerate(kept) if m != k]
        for s, j, _ in sorted(x for x in scored if x[2])[:5]:
            inside = sorted((t, n) for t, n, same in scored if not same and 80 * -s <= 100 * -t <= 100 * -s)[:5]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(inside)]
    return sorted(out)


def check(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("q", "grp", "chunk", "a", "score", "rank", "copies", "first")})
    out = hn.hard_negatives(frame)
    assert out.columns == COLUMNS
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    got = sorted(map(tuple, out.collect()))
    assert got == plain(rows)
    return got


@pytest.fixture
def small(monkeypatch):
    """Many groups, chunks and products on a small table."""
    for name, value in (("GROUP_LEAST", 40), ("GROUP_MOST", 40), ("CHUNK", 4), ("_ROWS", 16), ("_ANCHORS", 3)):
        monkeypatch.setattr(hn, name, value)


def random_rows(n, labels, grain, seed, width=4, every=20):
    rng = np.random.default_rng(seed)
    ids = [int(i) * (100 // every) for i in rng.permutation(n)]
    return [(i, [float(x) for x in np.round(rng.normal(0.1, 1, width) * grain) / grain], int(rng.integers(0, labels))) for i in ids]


@pytest.mark.parametrize("labels, grain", [(3, 100), (2, 1), (10, 2), (1, 10)], ids=["usual", "ties", "many labels", "one label"])
def test_equals_all_pairs(spark, small, labels, grain):
    got = check(spark, random_rows(240, labels, grain, seed=labels * 100 + grain))
    assert bool(got) or labels == 1


def test_scores_of_one_cell_and_of_many_are_the_same(spark, small, monkeypatch):
    rows = random_rows(240, 4, 50, seed=11)
    cut = check(spark, rows)
    for name, value in (("GROUP_LEAST", 1000), ("GROUP_MOST", 1000), ("CHUNK", 1000), ("_ROWS", 1000), ("_ANCHORS", 1000)):
        monkeypatch.setattr(hn, name, value)
    assert check(spark, rows) == cut


def test_hot_copies_repeated_anchors_and_equal_positives(spark, small):
    """A third of all rows one vector under many ids, one anchor row three times, equal scores at the window's limits."""
    rows = [(1000 + i, [1.0, 0.5], i % 2) for i in range(80)]
    rows += [(100, [1.0, 1.0], 1)] * 3 + [(200, [1.0, 0.0], 0), (300, [-1.0, -1.0], 0), (400, [0.0, 0.0], 1)]
    rows += [(i, [float(i % 9) / 8, float(i % 5) / 4], i % 3) for i in range(1, 99)]
    assert check(spark, rows)


def test_odd_rows(spark, small):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (100, [1.0], 1), (200, [], 1), (300, [0.5, 0.5, 0.5], 2), (None, [9.0, 9.0], 1), (1, None, 1), (2, [nan, 1.0], 2),
            (3, [inf, 1.0], 2), (4, [None, 1.0], 2), (5, [1.0, 1.0], None), (6, [1.0, 2.0], 1), (8, [1.0, 1.9], 3), (9, [0.9, 1.9], 3),
            (9, [0.9, 1.9], 3), (-100, [1.0, 1.0], 1), (-7, [1.0, 1.0], -2)]
    assert check(spark, rows)
    check(spark, [])
    check(spark, [(1, [1.0], 1), (2, [1.0], 2)])
    check(spark, [(100, [1.0], 1), (3, None, None)])


def test_large_components_stay_exact(spark, small):
    rng = np.random.default_rng(3)
    rows = [(i * 10, [float(x) for x in rng.normal(1e5, 2e4, 4)], int(rng.integers(0, 3))) for i in range(1, 60)]
    assert check(spark, rows)
    held = hn.hard_negatives(spark.createDataFrame([(100, [3e38], 1), (1, [3e38], 1), (2, [2e38], 2)], SCHEMA)).collect()
    assert [(r["negative_id"], r["negative_score"]) for r in held] == [(2, 1 << 60)]


def test_split_products_are_exact():
    rng = np.random.default_rng(4)
    most = 1 << 27
    x, y = rng.integers(-most, most + 1, (7, 64)), rng.integers(-most, most + 1, (9, 64))
    exact = (x.astype(object) @ y.T.astype(object))
    assert (hn._product(x, y, 64, most).astype(object) == exact).all()
    assert (hn._product(x >> 10, y >> 10, 64, most >> 10).astype(object) == ((x >> 10).astype(object) @ (y >> 10).T.astype(object))).all()
