"""Quality rules, the neighbour classifier and the pipeline's stages."""

import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from vigilo.llm import knn_quality as K
from vigilo.llm import quality_rules as Q
from vigilo.llm.minhash import near_duplicates

SF = "/root/testdata/sf0.001"


def counts(text):
    text = text or ""
    w = [x for x in re.split("[ \t-\r]+", text) if x]
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^ \t-\r]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [None, "", "a", "a b c a b c", "x x x x x", "l one\nl one\n\n \nl one ", "a\x0bb\x0cc\td\re", "# * $ <a> | ñ 😀😀 b", "w " * 30_000,
         " ".join(f"w{i % 700}" for i in range(5000)), "a b c d a b c e f a b c"]


def test_base_counts_match_brute_force(spark):
    df = spark.createDataFrame([(i, t, None, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, source string, lines string")
    for r in Q.quality_rules(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(TEXTS[r.doc_id]), r.doc_id
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert Q.quality_rules(df.limit(0)).count() == 0


def test_boilerplate_lines_and_depleted_documents(spark):
    body = lambda i: "\n".join(" ".join(f"d{i}w{j}k{k}" for k in range(12)) for j in range(6))
    mark = "All Rights  Reserved by the site " + " ".join(f"m{i}" for i in range(60))
    rows = [(i, body(i) + "\n" + mark, "h1") for i in range(30)] + [(100 + i, body(100 + i), "h1") for i in range(60)]
    rows += [(300, mark.lower() + "\nshort tail here", "h1"), (301, mark, "h2"), (302, body(7), None)]
    rows += [(400 + i, body(999), "h1") for i in range(40)]                    # copies of one document are one document
    rows.append((300, mark.lower() + "\nshort tail here", "h1"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    assert len(out[5].boilerplate) == 1 and out[5].kept and out[5].left_chars < out[5].word_chars
    assert not out[300].kept and not out[300].base_failed
    assert out[301].kept and out[302].kept and all(out[400 + i].kept for i in range(40))
    assert out[0].kept and out[0].left_chars == out[0].word_chars              # the first holder keeps the line
    clean = {r.doc_id: r.text for r in Q.cleaned(df, Q.quality_rules(df)).collect()}
    assert clean[0] == body(0) + "\n" + mark and clean[5] == body(5) and clean[300] == "short tail here" and clean[301] == mark


def test_depleted_documents_in_a_large_host(spark):
    """Planted in a host of 3,000 documents: a notice of 11 documents goes, one of 10 stays, near copies leave one."""
    body = lambda i, n=6: "\n".join(" ".join(f"d{i}w{j}k{k}" for k in range(12)) for j in range(n))
    notice = lambda name: " ".join(f"{name}{k}" for k in range(60))
    rows = [(i, body(i), "big") for i in range(3000)]
    rows += [(5000 + i, notice("gone") + f"\ntail{i}", "big") for i in range(11)]
    rows += [(6000 + i, notice("stay") + f"\ntail{i}", "big") for i in range(10)]
    rows += [(7000 + i, body("copy") + f"\nversion {i}", "big") for i in range(40)]
    rows += [(8000 + i, notice("gone") + f"\nelse{i}", f"other{i}") for i in range(20)]      # hosts count for themselves
    rows += [(None, notice("gone") + "\ntail3", "big")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    gone = {r.doc_id for r in Q.quality_rules(df).where("not kept").collect()}
    assert gone == {None} | {5000 + i for i in range(1, 11)} | {7000 + i for i in range(1, 40)}


def test_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in K.op8_nearest_neighbour_quality(spark, d).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    held = [(out[i].predicted, y) for i, y in labels.items() if out[i].held_out]
    assert sum(p == y for p, y in held) / len(held) >= 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())


def test_classifier_odd_rows(spark):
    docs = spark.createDataFrame([(0, "good words here", 1), (None, None, 1), (2, "", 0), (2, "", 0), (3, "x" * 300_000, 0)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = K.score(docs, K.fit(docs, none)).collect()
    assert len(out) == 5 and all(r.score == 0.5 for r in out)
    labels = spark.createDataFrame([(0, 1), (0, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    out = K.score(docs, K.fit(docs, labels)).collect()
    assert sorted((str(r.doc_id), r.held_out) for r in out)[:1] == [("0", zlib.crc32(b"0") % 3 == 1)]
    assert all(r.score == 0 for r in out if r.doc_id in (None, 2))
    assert K.score(docs.limit(0), None).count() == 0


def test_pipeline_stages_match_their_operators(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k == 0:
            want = {r.doc_id for r in Q.quality_rules(docs).where("kept").collect()}
        elif k == 1:
            model = K.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
            want = {r.doc_id for r in K.score(docs, model).where("predicted = 1").collect()}
        elif k == 2:
            want = {r.doc_id for r in near_duplicates(docs).where("kept").collect()}
        else:
            want = {r.doc_id for r in docs.collect()}
        assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == want, name
        if k < 4:
            assert out.columns == docs.columns and out.count() == len(want)
        if k == 3:
            for r in out.collect():
                assert r.n_chars == len(r.text) and (r.text == texts[r.doc_id]) == ("[hex]" not in r.text and "[assign]" not in r.text
                                                                                  and "[access]" not in r.text and "[weak" not in r.text)
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] and docs.agg(F.sum("length")).first()[0] > 0
