"""Invariants of the model-based operators (no bit parity with any other library is claimed)."""
import math

import pytest
from pyspark.sql import functions as F

from vigilo.operators import sampling as S
from vigilo.operators import thresholds as TH
from vigilo.operators.iforest import IsolationForest, average_path_length
from vigilo.operators.scaling import standardize


def test_average_path_length():
    assert list(average_path_length([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert average_path_length([256])[0] == pytest.approx(2 * (math.log(255) + 0.5772156649) - 2 * 255 / 256)


@pytest.fixture(scope="module")
def feats(spark):
    df = spark.range(600).select(
        F.col("id"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("a"),
        (F.pmod(F.xxhash64(F.col("id") + 7), F.lit(1000)) / 1000.0).alias("b"),
        F.when(F.col("id") < 20, F.lit(9.0)).otherwise(F.lit(0.0)).alias("c"))   # 20 planted outliers
    return df.persist()


def test_forest_invariants(spark, feats):
    cols = ["a", "b", "c"]
    z = standardize(feats, cols)
    model = IsolationForest(cols, n_trees=50, contamination=0.1, seed=7).fit(z)
    s = model.decision(z).withColumn("risk", TH.risk_from_decision("decision")).persist()
    r = s.agg(F.min("risk"), F.max("risk"), F.sum(F.col("is_flagged").cast("int")).alias("flagged"),
              F.sum(((F.col("risk") > 50) != F.col("is_flagged")).cast("int")).alias("disagree"),
              F.sum(F.when(F.col("id") < 20, F.col("is_flagged").cast("int"))).alias("planted")).first()
    assert 0 <= r[0] and r[1] <= 100
    assert r["disagree"] == 0                      # flag <=> unrounded risk > 50
    assert abs(r["flagged"] - 60) <= 2             # ~ contamination share
    assert r["planted"] == 20                      # planted outliers are found
    assert model.nodes.groupby("tree")["size"].max().max() <= 256
    # same seed -> same forest; repartitioned input -> same scores
    again = IsolationForest(cols, n_trees=50, contamination=0.1, seed=7).fit(z.repartition(5))
    assert again.offset == pytest.approx(model.offset)


def test_scores_in_the_plan_equal_the_batch_walk(spark, feats):
    """The same forest by higher-order functions and by Arrow batches; no Python worker in the plan of the first."""
    cols = ["a", "b", "c"]
    model = IsolationForest(cols, n_trees=12, max_samples=64, contamination=None, seed=3).fit(feats)
    plan = model.score_in_plan(feats)
    assert "Arrow" not in plan._jdf.queryExecution().executedPlan().toString()
    a = {r["id"]: r["score"] for r in plan.collect()}
    b = {r["id"]: r["score"] for r in model.score_samples(feats).collect()}
    assert set(a) == set(b) and all(a[i] == pytest.approx(b[i], abs=1e-12) for i in a)
    assert plan.columns == [*feats.columns, "score"]


def test_split_is_partition_invariant(spark, feats):
    a = S.stratified_split(feats.withColumn("label", F.col("id") % 3), "label").select("id", "split")
    b = S.stratified_split(feats.repartition(7).withColumn("label", F.col("id") % 3), "label").select("id", "split")
    assert a.exceptAll(b).count() == 0
    share = a.filter("split = 'test'").count() / 600
    assert 0.12 < share < 0.28


def test_knn_exact_and_smote(spark):
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(
        [(0, 0), (1, 0), (0, 1), (5, 5), (5, 6), (6, 5), (9, 9), (1, 1), (0, 0), (5, 5)])]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    nn = S.knn_within(df, ["x", "y"], k=3, window=1).collect()
    brute = {}
    for i, x, y in pts:
        d = sorted(((math.dist((x, y), (a, b)), j) for j, a, b in pts if j != i))
        brute[i] = [j for _, j in d[:3]]
    got = {}
    for r in sorted(nn, key=lambda r: (r["id"], r["nn"])):
        got.setdefault(r["id"], []).append(r["nbr_id"])
    assert got == brute
    lab = df.withColumn("y_lab", F.when(F.col("id") < 4, 1).otherwise(0))
    out = S.smote(lab, "y_lab", ["x", "y"], minority=1, k=2, seed=1)
    counts = {r["y_lab"]: r["count"] for r in out.groupBy("y_lab").count().collect()}
    assert counts[0] == counts[1] == 6
    syn = out.filter("synthetic").collect()
    assert len(syn) == 2
    for r in syn:   # synthetic rows lie inside the minority hull box
        assert 0 <= r["x"] <= 5 and 0 <= r["y"] <= 5


def test_class_weights(spark):
    df = spark.createDataFrame([(i, l) for i, l in enumerate([0, 0, 0, 1, 2, 2])], "id long, label int")
    w = {r["id"]: r["weight"] for r in S.class_weights(df, "label", "balanced").collect()}
    assert w[0] == pytest.approx(6 / (3 * 3)) and w[3] == pytest.approx(6 / 3)
    f = {r["id"]: r["weight"] for r in S.class_weights(df, "label", "fixed").collect()}
    assert f[4] == 4.0 and f[0] == 1.0


def test_exact_quantile_matches_numpy(spark):
    import numpy as np
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for q in (0.0, 0.1, 0.35, 0.5, 1.0):
        assert TH.exact_quantile(df, "v", q) == pytest.approx(float(np.percentile(vals, q * 100)))


def test_threshold_rules(spark):
    df = spark.createDataFrame([(0.3, 0.3, 0.4), (0.2, 0.2, 0.6), (0.1, 0.5, 0.4)], "p0 double, p1 double, p2 double")
    got = [r[0] for r in df.select(TH.threshold_label("p0", "p1", "p2", 0.5)).collect()]
    assert got == [0, 2, 1]   # tie 0 vs 1 -> 0


def test_knn_with_a_hot_copy_group(spark):
    """A third of the rows are copies of one vector: exact, and no quadratic blow-up."""
    import random
    rnd = random.Random(5)
    pts = [(i, 1.0, 1.0) for i in range(400)]
    pts += [(400 + i, rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for i in range(800)]
    pts += [(2000, 3.0, 3.0), (2001, 3.0, 3.0)]          # a small copy group (needs other vectors)
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {}
    for r in S.knn_within(df, ["x", "y"], k=3).collect():
        got.setdefault(r["id"], []).append((r["nn"], r["nbr_id"]))
    assert len(got) == len(pts)
    for i, x, y in rnd.sample(pts, 60) + [pts[0], pts[399], pts[-1], pts[-2]]:
        d = sorted((math.dist((x, y), (a, b)), j) for j, a, b in pts if j != i)
        assert [j for _, j in sorted(got[i])] == [j for _, j in d[:3]]


def test_status_multiclass_invariants(spark):
    from vigilo.operators import boosting as G
    rows = []
    for i in range(240):
        lab = i % 3
        rows.append((i, float(lab * 10 + (i % 7)), lab if i % 5 else (lab + 1) % 3, float((i * 37) % 1000),
                     i % 3, i % 2, i % 4, lab))
    df = spark.createDataFrame(rows, "id long, days_since_last_payment double, previous_term_status int, "
                                     "total_outstanding double, income_encoded int, transport_user int, "
                                     "sibling_count int, label int")
    w = S.class_weights(df, "label", "fixed", minority=2, factor=4.0)
    m = G.fit_status_multiclass(w, weight_col="weight", maxIter=5, maxDepth=3)
    p = m.predict(df).select("p_0", "p_1", "p_2", "label_pred").collect()
    for r in p:
        assert r["p_0"] + r["p_1"] + r["p_2"] == pytest.approx(1.0)
        want = 2 if r["p_2"] >= 0.5 else (0 if r["p_0"] >= r["p_1"] else 1)
        assert r["label_pred"] == want
    imp = m.importances(spark).collect()
    assert sum(x["importance"] for x in imp) == pytest.approx(1.0, abs=1e-6)
    assert [x["rank"] for x in imp] == list(range(1, 7))


def test_knn_by_cells_is_exact_and_its_jobs_do_not_grow(spark):
    """Dense lines, ties and far outliers over many cells: brute force agrees, and ten times the rows take no more jobs."""
    import random
    rnd = random.Random(11)

    def rows(n):
        near = [(i, rnd.gauss(0, 1) * 1e4, rnd.randrange(4), 0.0) for i in range(n)]
        line = [(n + i, float(i % 7), 0, float(i)) for i in range(n)]       # dense along both directions of largest variance
        grid = [(2 * n + i, i % 20, i // 20 % 20, -1e6) for i in range(n)]  # many equal distances
        return [(i, float(x), float(y), float(z)) for i, x, y, z in [*near, *line, *grid]] + [(9 * n, 1e9, 0.0, 0.0), (9 * n + 1, None, 0.0, 0.0)]

    def run(pts, group):
        sc = spark.sparkContext
        sc.setJobGroup(group, group)
        got = {}
        for r in S.knn_within(spark.createDataFrame(pts, "id long, x double, y double, z double"), ["x", "y", "z"], k=3, window=4).collect():
            got.setdefault(r["id"], []).append((r["nn"], r["nbr_id"], r["dist"]))
        sc.setJobGroup("tests", "")
        return got, len(sc.statusTracker().getJobIdsForGroup(group))

    few, jobs_few = run(rows(60), "knn-few")
    pts = rows(600)
    got, jobs = run(pts, "knn-many")
    known = [p for p in pts if p[1] is not None]
    assert len(got) == len(known) and jobs <= jobs_few + 10
    for i, x, y, z in rnd.sample(known, 150) + known[-1:]:
        def far(a, b, c):
            return math.sqrt((x - a) * (x - a) + (y - b) * (y - b) + (z - c) * (z - c))
        want = sorted((far(a, b, c), j) for j, a, b, c in known if j != i)[:3]
        assert [(d, j) for _, j, d in sorted(got[i])] == want


def test_blocks_of_a_large_cell_give_the_neighbours_of_all_distances():
    import numpy as np
    from vigilo.operators import nearest as N
    rng = np.random.default_rng(3)
    p = np.vstack([rng.integers(0, 9, (900, 2)), rng.normal(size=(900, 2)) * 5, [[np.nan, 0.0], [np.inf, 1.0]]])
    p = np.unique(p, axis=0)
    code = rng.permutation(len(p))
    order = np.argsort(code)
    want = N._whole(p, code, p[order], code[order], 4)
    got = N._k_nearest(p, code, p, code, 4, np.full(len(p), np.inf))
    assert len(p) > N.BLOCK_ROWS and all(np.array_equal(a, b, equal_nan=True) for a, b in zip(want, got))


def test_knn_where_only_a_few_vectors_need_others(spark):
    """Nearly all vectors have many copies: cells without a searching row give nothing and do not fail."""
    pts = [(i, float(i % 400), float(i % 400 * 7 % 400)) for i in range(2400)] + [(3000, 1.5, 2.5)]
    got = {}
    for r in S.knn_within(spark.createDataFrame(pts, "id long, x double, y double"), ["x", "y"], k=3, window=2).collect():
        got.setdefault(r["id"], []).append((r["nn"], r["nbr_id"]))
    assert len(got) == len(pts)
    for i, x, y in pts[:5] + pts[-1:]:
        want = sorted((math.dist((x, y), (a, b)), j) for j, a, b in pts if j != i)[:3]
        assert [j for _, j in sorted(got[i])] == [j for _, j in want]


def test_rounds_of_the_binary_fit_leave_the_lineage_of_its_rows_behind(spark):
    """The driver keeps every stage of a job's lineage, run or skipped: a round's job has its own two only."""
    from vigilo.operators import boosting as G
    sc = spark.sparkContext
    df = spark.range(400).select("id", (F.pmod(F.xxhash64("id"), F.lit(100)) / 10.0).alias("a"), F.pmod("id", F.lit(3)).cast("double").alias("b"))
    for n in (2, 3, 4):  # rows made by several shuffles
        df = df.repartition(n, "id")
    df = df.withColumn("y", (F.col("a") > 6).cast("int"))
    sc.setJobGroup("binary-fit", "rounds")
    try:
        model = G.fit_default_binary(df, ["a", "b"], "y", maxIter=3)
        jobs = sorted(sc.statusTracker().getJobIdsForGroup("binary-fit"))
    finally:
        sc.setJobGroup("", "")
    assert model.iterations == 3 and not df.is_cached
    stages = [len(sc.statusTracker().getJobInfo(j).stageIds) for j in jobs[-6:]]
    assert max(stages) <= 2, stages
