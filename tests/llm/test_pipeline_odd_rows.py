"""Every stage on nulls, repeats, clashing extra columns and an empty table."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_take_odd_tables(spark):
    good = " ".join(f"word{i}" for i in range(200))
    rows = [(1, good, "en", "s", 9), (1, good, "en", "s", 9), (2, None, None, None, None), (None, good, "en", None, 9), (3, "", "en", "s", 0),
            (4, good + " token=abcdef123 end", "en", "s", 9), (5, good + " tail", "fr", "t", None)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    extra = spark.createDataFrame([(*r, 1, "x", True) for r in rows], columns + ", sid long, linked string, kept boolean")
    empty = extra.limit(0)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, extra, SF)
        assert stage(spark, empty, SF).count() == 0, name
        if k < 4:
            assert out.columns == extra.columns, name
        got = sorted(str(r.doc_id) for r in out.collect())
        if k == 0:
            assert got == ["1", "1", "4", "5"]
        elif k == 2:
            assert got == ["1", "2", "3"]
        elif k == 3:
            assert len(got) == len(rows) and [r.text for r in out.collect() if r.doc_id == 4] == [good + " [assign] end"]
        elif k == 4:
            assert set(got) == {"1", "2", "3", "4", "5", "None"}


def test_verdicts_follow_id_and_text(spark):
    good, other = (" ".join(f"{w}{i}" for i in range(200)) for w in ("word", "term"))
    docs = spark.createDataFrame([(1, good, "en", "s", 9), (1, "bad", "en", "s", 3), (0, other, "en", "s", 9), (1, other + " end", "en", "s", 9)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = lambda k: sorted((r.doc_id, r.text) for r in corpus_pipeline.STAGES[k][1](spark, docs, SF).collect())
    assert kept(0) == sorted([(1, good), (0, other), (1, other + " end")])
    assert kept(2) == sorted([(1, good), (1, "bad"), (0, other)])
