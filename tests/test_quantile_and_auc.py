"""Bracketed quantiles and bucketed AUC against NumPy and all pairs."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilo.operators import evaluation as E
from vigilo.operators import thresholds as TH

RNG = np.random.default_rng(6)
COLUMNS = {
    "normal": RNG.normal(0, 1, 4000),
    "few values": RNG.integers(0, 7, 4000).astype(float),
    "an atom": np.where(RNG.random(4000) < 0.6, 0.25, RNG.random(4000)),
    "one value": np.full(300, 2.5),
    "two values": np.array([1.0] * 250 + [9.0] * 250),
    "wide": np.concatenate([10.0 ** RNG.uniform(-300, 300, 1000), -(10.0 ** RNG.uniform(-300, 300, 1000))]),
    "single": np.array([3.0]),
}


@pytest.mark.parametrize("ranked", [20, 100_000], ids=["narrowed", "ranked at once"])
@pytest.mark.parametrize("name", COLUMNS)
def test_quantiles_equal_numpy(spark, monkeypatch, name, ranked):
    monkeypatch.setattr(TH, "RANKED", ranked)
    values = COLUMNS[name]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4).persist()
    for q in (0.0, 0.1, 0.5, 0.777, 1.0):
        want = float(np.percentile(values, q * 100)) if name != "wide" else None
        h = (len(values) - 1) * q
        a, b = np.sort(values)[[int(h // 1), int(-(-h // 1))]]
        got = TH.exact_quantile(df, "v", q)
        assert got == a + (h - int(h // 1)) * (b - a)
        assert want is None or got == pytest.approx(want, abs=1e-12)
    df.unpersist()


@pytest.mark.parametrize("shift", [-0.4, 0.4, 1.0])
def test_a_wrong_sketch_never_gives_a_wrong_quantile(spark, monkeypatch, shift):
    """Brackets that miss the ranks are noticed by the counts."""
    monkeypatch.setattr(TH, "RANKED", 20)
    right = TH._around
    monkeypatch.setattr(TH, "_around", lambda s, seen, a, b, lo, hi: right(s, seen, a + shift, b + shift, lo, hi))
    values = COLUMNS["normal"][:900]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for q in (0.1, 0.5, 0.93):
        assert TH.exact_quantile(df, "v", q) == pytest.approx(float(np.percentile(values, q * 100)), abs=1e-12)


def test_ranks_on_both_sides_of_a_bracket(spark, monkeypatch):
    monkeypatch.setattr(TH, "RANKED", 3)
    df = spark.createDataFrame([(float(v),) for v in range(10)], "v double")
    for lo, hi in ((0.0, 4.0), (5.0, 9.0), (4.5, 9.0), (0.0, 4.5)):     # ranks 4 and 5 of q = 0.5
        monkeypatch.setattr(TH, "_around", lambda *a, lo=lo, hi=hi: (lo, hi))
        assert TH.exact_quantile(df, "v", 0.5) == 4.5


def test_quantile_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (2.0,)], "v double")
    assert TH.exact_quantile(df, "v", 0.5) == 1.5
    assert TH.exact_quantile(df.where("v is null"), "v", 0.5) is None
    with pytest.raises(ValueError):
        TH.exact_quantile(df, "v", 1.1)


def all_pairs(rows):
    key = lambda s: (0, 0.0) if s is None else (2, 0.0) if s != s else (1, s)
    pos, neg = [key(s) for y, s in rows if y == 1], [key(s) for y, s in rows if y != 1]
    wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else 0.0


def scored(name, n=500):
    rng = random.Random(name)
    inf, nan = float("inf"), float("nan")
    draw = {"uniform": lambda y: rng.random() * 0.7 + 0.3 * y, "rounded": lambda y: round(rng.random() * 0.6 + 0.4 * y, 1),
            "one score": lambda y: 0.5, "separate": lambda y: y + rng.random() / 2,
            "an outlier": lambda y: rng.random() * 1e-9 if rng.random() < 0.99 else 1e12,
            "extremes": lambda y: rng.choice([None, nan, inf, -inf, 1.7e308, -1.7e308, 0.0, -0.0, 5e-324, rng.random()])}[name]
    return [(y, draw(y)) for y in (rng.randint(0, 1) for _ in range(n))]


@pytest.mark.parametrize("buckets, ranked", [(1 << 16, 1 << 20), (4, 30), (3, 1)], ids=["usual", "refined", "refined to the end"])
@pytest.mark.parametrize("name", ["uniform", "rounded", "one score", "separate", "an outlier", "extremes"])
def test_auc_equals_all_pairs(spark, monkeypatch, name, buckets, ranked):
    monkeypatch.setattr(E, "AUC_BUCKETS", buckets)
    monkeypatch.setattr(E, "AUC_RANKED", ranked)
    n = 500 if ranked > 1 else 60
    rows = scored(name, n)
    df = spark.createDataFrame(rows, "y_true int, prob double").repartition(3)
    assert E.roc_auc(df).first()["auc"] == pytest.approx(all_pairs(rows), abs=1e-12)


def test_auc_of_odd_tables(spark):
    schema = "y_true int, prob double"
    assert E.roc_auc(spark.createDataFrame([], schema)).first()["auc"] == 0.0
    assert E.roc_auc(spark.createDataFrame([(1, 0.3), (1, 0.9)], schema)).first()["auc"] == 0.0
    assert E.roc_auc(spark.createDataFrame([(1, 0.31), (0, 0.29), (None, 0.34)], schema), round_digits=1).first()["auc"] == 0.5


def test_only_mixed_buckets_are_refined(spark, monkeypatch):
    """Scores in two pure halves and one mixed cell: the refinement reads the rows of that cell only."""
    seen = []
    right = E._doubled_pairs
    monkeypatch.setattr(E, "AUC_BUCKETS", 100)
    monkeypatch.setattr(E, "_doubled_pairs", lambda cells, *a: seen.append(cells.agg(F.sum(F.col("pos") + F.col("neg"))).first()[0]) or right(cells, *a))
    rows = [(0, i / 1000) for i in range(500)] + [(1, i / 1000) for i in range(510, 1000)] + [(i % 2, 0.5 + i / 10_000) for i in range(90)]
    assert E.roc_auc(spark.createDataFrame(rows, "y_true int, prob double")).first()["auc"] == pytest.approx(all_pairs(rows), abs=1e-12)
    assert seen[0] == len(rows) and seen[1] < 120
