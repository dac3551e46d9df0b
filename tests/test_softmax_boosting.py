"""Multinomial boosting against a plain NumPy version that searches raw values row by row."""
import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilo.operators import softmax_boosting as SB

FEATURES = ["a", "b", "c"]


def sample(n=500, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 40, n), np.round(rng.normal(0, 2, n), 1), rng.integers(0, 2, n)], 1).astype(float)
    score = x[:, 0] / 10 + x[:, 1] + rng.normal(0, 0.7, n)
    y = np.where(score > 4, 2, np.where(score + x[:, 2] > 1.5, 1, 0))
    return x, y, np.where(y == 2, 4.0, 1.0)


def frame(spark, x, y, w, parts=3):
    rows = [(i, *map(float, v), int(k), float(u)) for i, (v, k, u) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label int, weight double").repartition(parts)


def plain(x, y, w, k_classes, rounds, rate, depth):
    """Recursive trees on raw values: every midpoint of every feature is tried on the node's rows."""
    scores = np.log(np.tile(np.bincount(y, w, minlength=k_classes) / w.sum(), (len(y), 1)))
    losses = []

    def grow(rows, r, level):
        best = (0, None, None)
        if level < depth:
            for j in range(x.shape[1]):
                values = np.unique(x[rows, j])
                for cut in (values[1:] + values[:-1]) / 2:
                    left = x[rows, j] <= cut
                    wl, wr = w[rows][left].sum(), w[rows][~left].sum()
                    gap = (w * r)[rows][left].sum() / wl - (w * r)[rows][~left].sum() / wr
                    gain = wl * wr / (wl + wr) * gap * gap
                    if gain > best[0] * (1 + 1e-9) + 1e-12:
                        best = (gain, j, cut)
        if best[1] is None:
            curve = (w * np.abs(r) * (1 - np.abs(r)))[rows].sum()
            return (k_classes - 1) / k_classes * (w * r)[rows].sum() / curve if abs(curve) > 1e-150 else 0.0
        left = x[rows, best[1]] <= best[2]
        return best[1], best[2], grow(rows[left], r, level + 1), grow(rows[~left], r, level + 1)

    def at(tree, v):
        while isinstance(tree, tuple):
            tree = tree[2] if v[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(rounds):
        p = np.exp(scores) / np.exp(scores).sum(1, keepdims=True)
        losses.append(-(w * np.log(p[np.arange(len(y)), y])).sum() / w.sum())
        new = scores.copy()
        for k in range(k_classes):
            tree = grow(np.arange(len(y)), (y == k) - p[:, k], 0)
            new[:, k] += rate * np.array([at(tree, v) for v in x])
        scores = new
    p = np.exp(scores) / np.exp(scores).sum(1, keepdims=True)
    return p, [*losses, -(w * np.log(p[np.arange(len(y)), y])).sum() / w.sum()]


def probabilities(model, df):
    rows = model.predict_proba(df).orderBy("id").select(*[f"p_{k}" for k in model.classes]).collect()
    return np.array([list(r) for r in rows])


@pytest.mark.parametrize("rounds, depth", [(1, 1), (6, 3), (4, 4)])
@pytest.mark.parametrize("partition_rows", [1000, 90], ids=["in a task", "a job per level"])
def test_equals_plain_numpy(spark, monkeypatch, rounds, depth, partition_rows):
    monkeypatch.setattr(SB, "PARTITION_ROWS", partition_rows)
    x, y, w = sample()
    df = frame(spark, x, y, w)
    model = SB.fit_softmax_boosting(df, FEATURES, weight_col="weight", rounds=rounds, rate=0.3, depth=depth)
    want, losses = plain(x, y, w, 3, rounds, 0.3, depth)
    assert np.abs(probabilities(model, df) - want).max() < 1e-9
    assert model.losses == pytest.approx(losses, abs=1e-10)


def test_loss_falls_each_round_and_partitions_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(SB, "PARTITION_ROWS", 100)
    monkeypatch.setattr(SB, "BLOCK_ROWS", 60)
    monkeypatch.setattr(SB, "CHECKPOINT_EVERY", 4)
    x, y, w = sample()
    many = SB.fit_softmax_boosting(frame(spark, x, y, w, 7), FEATURES, weight_col="weight", rounds=12, depth=3)
    assert all(b < a for a, b in zip(many.losses, many.losses[1:])) and len(many.losses) == 13
    monkeypatch.setattr(SB, "PARTITION_ROWS", 10_000)
    monkeypatch.setattr(SB, "BLOCK_ROWS", 10_000)
    one = SB.fit_softmax_boosting(frame(spark, x, y, w, 1), FEATURES, weight_col="weight", rounds=12, depth=3)
    assert (one.feature == many.feature).all() and np.abs(one.value - many.value).max() < 1e-9
    assert probabilities(one, frame(spark, x, y, w)).sum(1) == pytest.approx(np.ones(len(y)))


def test_one_job_set_a_round_for_all_classes(spark, monkeypatch):
    """depth jobs a round whatever the number of classes: the classes share them."""
    monkeypatch.setattr(SB, "PARTITION_ROWS", 50)
    x, y, w = sample(120)
    sc = spark.sparkContext
    jobs = {}
    for k_classes, labels in ((3, y), (5, np.arange(len(y)) % 5)):
        sc.setJobGroup(f"softmax-{k_classes}", "count jobs")
        SB.fit_softmax_boosting(frame(spark, x, labels, w, 1), FEATURES, classes=tuple(range(k_classes)), rounds=5, depth=2)
        jobs[k_classes] = len(sc.statusTracker().getJobIdsForGroup(f"softmax-{k_classes}"))
        sc.setJobGroup("tests", "")
    assert jobs[3] == jobs[5] and 5 * 2 < jobs[3] < 5 * 2 + 20


def test_many_distinct_values_become_quantile_bins(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (2000, 3))
    y = (x[:, 0] + 0.3 * x[:, 1] > 0).astype(int) + (x[:, 0] > 1)
    model = SB.fit_softmax_boosting(frame(spark, x, y, np.ones(2000)), FEATURES, rounds=20, rate=0.3, depth=3)
    assert (probabilities(model, frame(spark, x, y, np.ones(2000))).argmax(1) == y).mean() > 0.95
    importances = model.feature_importances()
    assert sum(importances) == pytest.approx(1) and importances[0] > importances[1] > importances[2]


def test_saved_model_scores_the_same(spark, tmp_path):
    x, y, w = sample(200)
    df = frame(spark, x, y, w)
    model = SB.fit_softmax_boosting(df, FEATURES, rounds=4, depth=3).with_threshold(0.3)
    model.save(str(tmp_path / "m"))
    again = SB.SoftmaxBoosting.load(spark, str(tmp_path / "m"))
    assert (probabilities(again, df) == probabilities(model, df)).all()
    assert (again.threshold, again.iterations, again.losses) == (0.3, 4, model.losses)


def test_odd_training_tables(spark):
    x, y, w = sample(60)
    df = frame(spark, x, y, w)
    with pytest.raises(ValueError):
        SB.fit_softmax_boosting(df.limit(0), FEATURES, rounds=1)
    with pytest.raises(Exception, match="none of"):
        SB.fit_softmax_boosting(df, FEATURES, classes=(0, 1), rounds=1)
    with pytest.raises(Exception, match="null"):
        SB.fit_softmax_boosting(df.withColumn("a", F.lit(None).cast("double")), FEATURES, rounds=1)
    # constant features and a class without rows: no split, the priors stay
    flat = SB.fit_softmax_boosting(df.withColumns({c: F.lit(1.0) for c in FEATURES}), FEATURES, classes=(0, 1, 2, 7), rounds=2, depth=2)
    share = np.bincount(y, minlength=4) / len(y)
    assert probabilities(flat, df)[0] == pytest.approx(share, abs=0.05) and (flat.feature < 0).all()


def test_the_driver_gets_splits_and_no_histograms(spark):
    """What a level sends to the driver does not depend on the bins or the partitions."""
    rng = np.random.default_rng(4)
    bins, feature, cut = 256, np.full((3, 7), -1), np.zeros((3, 7), np.int64)
    x, y = rng.integers(0, bins, (4000, 2)).astype(np.uint8), rng.integers(0, 3, 4000).astype(np.uint8)
    block = lambda rows: (x[rows], y[rows], np.ones(len(rows)), np.zeros((len(rows), 3)))
    loss, want = SB._block_splits(block(np.arange(4000)), 0, bins, feature, cut, 1)
    state = spark.sparkContext.parallelize([block(rows) for rows in np.array_split(np.arange(4000), 8)], 8)
    whole_loss, got = SB._merged_splits(state, 0, bins, feature, cut, 1)
    assert whole_loss == pytest.approx(loss) and got.keys() == want.keys() == {(0, 0), (1, 0), (2, 0)}
    for at in want:
        assert np.allclose(got[at][0], want[at][0]) and got[at][1][1:3] == want[at][1][1:3]
    assert len(pickle.dumps(got)) < 4000
