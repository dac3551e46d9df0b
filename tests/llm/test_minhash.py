"""Near-duplicate classes: signature, exact classes against brute force, hot groups, odd inputs."""

import itertools
import random

import numpy as np

from vigilo.llm import graph
from vigilo.llm import minhash as M


def shingles(text):
    w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = [x for x in __import__("re").split("[ \t-\r]+", w) if x]
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {k: k for k in range(len(sets))}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        low[find(k)] = min(low.get(find(k), i), i)
    return sorted((i, len(s), low[find(k)] if s else i) for k, (i, s) in enumerate(sets))


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        return words
    docs = [text(rnd.randint(1, 120)) for _ in range(60)]
    hub = text(150)
    docs += [edited(hub, rnd.randint(0, 9)) for _ in range(120)]          # a large near-copy group around the threshold
    passage = text(60)
    docs += [passage + text(rnd.randint(5, 80)) for _ in range(60)]       # one passage in many documents
    chain = text(100)
    for _ in range(12):                                                    # a chain: neighbours alike, ends not
        chain = edited(chain, 2)
        docs.append(chain)
    docs += [docs[3]] * 5 + [["Solo"], ["solo"], []]
    rnd.shuffle(docs)
    return [(i * 7, " ".join(w)) for i, w in enumerate(docs)]


def test_classes_equal_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(seed)
        rows = M.near_duplicates(spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, sid int")).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute(docs)
        assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_odd_rows(spark):
    df = spark.createDataFrame([(5, "A b c d e f"), (3, "a  b\tc d\ne f"), (3, "a  b\tc d\ne f"), (None, "a b c d e f"), (9, None), (8, ""), (None, " ")],
                               "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in M.near_duplicates(df).collect())
    assert got == sorted([("5", 2, "3", False), ("3", 2, "3", True), ("3", 2, "3", True), ("None", 2, "3", False), ("9", 0, "9", True),
                          ("8", 0, "8", True), ("None", 0, "None", False)])
    assert M.near_duplicates(df.limit(0)).count() == 0


def test_text_without_any_id_links_and_bridges(spark):
    base = [f"b{i}" for i in range(100)]
    left, right = " ".join([f"x{i}" for i in range(10)] + base[10:]), " ".join(base[:90] + [f"y{i}" for i in range(10)])
    near = lambda p: " ".join(f"{p}{i}" for i in range(60))
    rows = [(1, left), (None, " ".join(base)), (None, " ".join(base)), (2, right), (None, near("n")), (3, near("n") + " tail"),
            (None, near("m")), (None, near("m") + " tail"), (4, near("z"))]
    assert brute([(1, left), (2, right)]) == [(1, 96, 1), (2, 96, 2)]
    out = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in out)
    assert got == sorted([("1", 96, "1", True), ("None", 96, "1", False), ("None", 96, "1", False), ("2", 96, "1", False), ("None", 56, "3", False),
                          ("3", 57, "3", True), ("None", 56, "None", False), ("None", 57, "None", False), ("4", 56, "4", True)])


def test_coordinates_come_from_one_shifted_permutation():
    ids = M.shingle_ids(" ".join(f"t{i}" for i in range(400)))
    other = M.shingle_ids(" ".join(f"t{i}" for i in range(40, 440)))
    a, b = M.circulant_signature(ids, 600), M.circulant_signature(other, 600)
    true = len(np.intersect1d(ids, other)) / len(np.union1d(ids, other))
    assert abs((a == b).mean() - true) < 0.08
    assert (M.circulant_signature(ids, 64) == a[:64]).all()
    ranks = M._mix32(np.arange(1 << 16, dtype=np.uint32))
    assert len(np.unique(ranks)) == 1 << 16


def test_long_text():
    assert len(M.shingle_ids("a " * 300_000)) == 1
    assert len(M.shingle_ids(" ".join(map(str, range(200_000))))) == 199_996


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(1, 50)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for n in near:
        seen, todo = {n}, [n]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        assert got[n] == min(seen)
    assert set(got) == set(near)
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0
