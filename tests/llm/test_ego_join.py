"""Epsilon grid order join against brute force, hot vectors, odd inputs."""

import random

import numpy as np

from vigilo.llm import ego_join as M


def brute(rows):
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n = {k: 0 for k in range(len(ok))}
    parent = list(range(len(ok)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(ok)):
        for b in range(a):
            x, y = ok[a][1], ok[b][1]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95:
                n[a] += 1
                n[b] += 1
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(ok):
        low[find(k)] = min(low.get(find(k), i), i)
    good = {id(v): (i, n[k], low[find(k)]) for k, (i, v) in enumerate(ok)}
    alone = [(i, 0, i) for i, v in rows if not (v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v))]
    return sorted([*good.values(), *alone])


def vectors(seed, n=400, d=16):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, d))
    rows = []
    for i in range(n):
        c = centres[int(rnd.integers(0, 12))]
        rows.append((i * 3, [float(np.float32(x)) for x in c + rnd.normal(size=d) * rnd.choice([0.05, 0.15, 0.3, 1.0])]))
    rows += [(5000 + i, rows[0][1]) for i in range(60)]                     # a hot vector
    rows += [(6000, None), (6001, [0.0] * d), (6002, [float("nan")] * d), (6003, [None] + [1.0] * (d - 1)), (6004, [float("inf")] * d),
             (6005, [1.0, 2.0]), (6006, [2.0, 4.0]), (6007, []), (6008, [x * 1000 for x in rows[1][1]])]
    return rows


def test_links_and_classes_equal_brute_force(spark, monkeypatch):
    for seed, block in ((1, 1024), (2, 64)):
        monkeypatch.setattr(M, "BLOCK", block)
        rows = vectors(seed)
        out = M.near_vectors(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, node int")).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == brute(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [2.0, 0.0]), (None, None), (2, [1e-30, 0.0])], "vec_id long, embedding array<float>")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in M.near_vectors(df).collect())
    assert got == sorted([("1", 3, "1", True), ("1", 3, "1", True), ("None", 3, "1", False), ("None", 0, "None", False), ("2", 3, "1", False)])
    assert M.near_vectors(df.limit(0)).count() == 0
    assert M.near_vectors(df.where("vec_id is null and embedding is null")).count() == 1


def test_one_distinct_vector(spark):
    hot = [(i, [0.5, -2.0, 0.25]) for i in range(5)]
    for rows in ([(7, [3.0, 4.0])], [(7, [-2.0])], hot, [*hot, (9, None), (10, [0.0] * 3)]):
        out = M.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == brute(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_halving_finds_the_leaves_in_reach():
    """Level by level with unequal depths, against all pairs of leaves; one step a level, however many pairs."""
    rnd, reach = np.random.default_rng(3), (2 - 2 * M.MIN_COSINE) ** 0.5
    parts = lambda p: [p[s:s + M.LEAF] for s in range(0, len(p), M.LEAF)]
    for n, m in ((1000, 70), (5, 900), (M.LEAF, M.LEAF + 1), (1, 1), (777, None)):
        x = rnd.uniform(-1, 1, size=(n, 3))
        x = x[np.lexsort(x.T[::-1])]
        y = x if m is None else rnd.uniform(-1, 1, size=(m, 3))
        got = list(zip(*(k.tolist() for k in M._near_leaves(M._boxes(x), M._boxes(y), m is None))))
        want = []
        for i, p in enumerate(parts(x)):
            for j, q in enumerate(parts(y)):
                gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
                if gap @ gap <= reach * reach + 1e-9 and (m is not None or i <= j):
                    want.append((i, j))
        assert sorted(got) == want and len(set(got)) == len(got)


def test_a_block_pair_is_joined_whole():
    """Blocks of many leaves: links and classes of one pair and of a block with itself equal brute force."""
    rnd = np.random.default_rng(4)
    x = np.tile(rnd.normal(size=(90, 8)), (10, 1)) + rnd.normal(size=(900, 8)) * 0.15
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    basis = np.linalg.qr(rnd.normal(size=(8, 6)))[0]
    frame = lambda k: M.pd.DataFrame({"node": k, "size": k % 3 + 1, "v": [x[i].tobytes() for i in k]})
    for left, right in ((np.arange(900), np.arange(900)), (np.arange(0, 500), np.arange(500, 900))):
        same = len(right) == 900
        got = M._linked(basis)((0, 0 if same else 1), frame(left), frame(right)).set_index("node")
        hit = x @ x.T >= M.MIN_COSINE
        np.fill_diagonal(hit, False)
        if not same:
            hit[:500, :500] = hit[500:, 500:] = False
        links = hit @ (np.arange(900) % 3 + 1)
        assert links.any() and got["links"].to_dict() == {i: int(n) for i, n in enumerate(links) if n}
        low = np.arange(900)
        for _ in range(60):
            low = np.minimum(low, np.where(hit, low[None, :], 900).min(1))
        root = got["root"].to_dict()
        assert len({(root[i], low[i]) for i in root}) == len(set(root.values())) == len({low[i] for i in root})


def test_joining_lots_moves_no_vector(spark, monkeypatch):
    """What a lot pair needs is read from the staged sequence: the step that joins has no shuffle, and no step stages a copy a pair."""
    from vigilo.llm.common import staged

    plans, rnd = {}, np.random.default_rng(5)
    monkeypatch.setattr(M, "BLOCK", 64)

    def seen(df, label):
        out = staged(df, label)
        plans[label] = (df._jdf.queryExecution().executedPlan().toString(), out.count())
        return out
    monkeypatch.setattr(M, "staged", seen)
    rows = [(i, v) for i, v in enumerate(rnd.normal(size=(1000, 64)).tolist())]
    M.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    plan, _ = plans["found"]
    assert "Exchange" not in plan and "CartesianProduct" in plan
    assert max(n for _, n in plans.values()) <= 1000


def at_cosine(x, c, rnd):
    """A unit vector at cosine c to the unit vector x."""
    y = rnd.normal(size=len(x))
    y -= (y @ x) * x
    return c * x + (1 - c * c) ** 0.5 * y / np.linalg.norm(y)


def test_links_about_the_threshold_are_decided_in_double_precision(spark, monkeypatch):
    """Pairs closer to the threshold than single precision tells, among lots of one block and vectors of two lengths."""
    rnd, rows = np.random.default_rng(6), []
    for width, n in ((64, 300), (48, 150)):
        x = rnd.normal(size=(n, width))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        off = [0, 0.01, -0.01, 1e-5, -1e-5, 1e-7, -1e-7, 1e-11, -1e-11]
        y = [at_cosine(v, 0.95 + off[1 + i % 8], rnd) * 10 ** rnd.uniform(-3, 3) for i, v in enumerate(x)]
        rows += [v.tolist() for v in [*x, *y]]
    rows = list(enumerate(rows))
    want = brute(rows)
    assert sum(n for _, n, _ in want) == 450
    for lot in (M.LOT, 64 * 8 * 30):
        monkeypatch.setattr(M, "BLOCK", 64)
        monkeypatch.setattr(M, "LOT", lot)
        out = M.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == want


def test_a_leading_bound_leaves_no_link_out():
    """Blocks wide enough for the bound in leading dimensions, with hubs, equal brute force."""
    rnd = np.random.default_rng(8)
    x = np.concatenate([rnd.normal(size=(600, 64)), np.repeat(rnd.normal(size=(20, 64)), 30, axis=0)])
    x[600:] += rnd.normal(size=(600, 64)) * rnd.choice([0.1, 0.2, 0.25], size=(600, 1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    basis = np.linalg.qr(rnd.normal(size=(64, 31)))[0]
    x = x[rnd.permutation(1200)]
    frame = lambda k: M.pd.DataFrame({"node": k, "size": 1, "v": [x[i].tobytes() for i in k]})
    got = M._linked(basis)((0, 1), frame(np.arange(700)), frame(np.arange(700, 1200))).set_index("node")["links"]
    hit = x[:700] @ x[700:].T >= M.MIN_COSINE
    links = np.concatenate([hit.sum(1), hit.sum(0)])
    assert links.any() and got.to_dict() == {i: int(n) for i, n in enumerate(links) if n}


def test_zeros_of_both_signs_are_equal(spark):
    rows = [(3, [0.0, 1.0]), (4, [-0.0, 1.0]), (5, [-0.0, 1.0]), (6, [1.0, -0.0])]
    for kind in ("float", "double"):
        out = M.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(3, 2, 3), (4, 2, 3), (5, 2, 3), (6, 0, 6)]


def test_classes_of_edges():
    nodes, low = M._classes(np.array([9, 4, 7, 30, 5]), np.array([4, 2, 30, 7, 5]))
    assert nodes.tolist() == [2, 4, 5, 7, 9, 30] and low.tolist() == [2, 2, 5, 7, 2, 7]
    path = np.random.default_rng(9).permutation(5000)
    assert (M._classes(path[:-1], path[1:])[1] == 0).all()
