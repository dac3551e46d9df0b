"""SentencePiece lattice: against the library's own best-path decoder on the same pieces, round trips, odd inputs."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from vigilo.llm import sp_lattice as M

PATH = public_tokenizers.path(M.MODEL)
HARD = ["", None, " ", "  two  spaces ", "The cat sat on the mat.", "naïve café, Straße!", "línea\ncon ñ\n\n", "日本語 テスト 123 45.6", "😀 x\ty\r\n",
        "a" * 5000, "x" * 64 + " " + "y" * 65, "i.e. don't re-do (this) [or] {that}: 50%% &&& ***", "zażółć gęślą jaźń", "龘龘   end"]


def best_path_library():
    """The installed library reading the same pieces as a unigram model (its model type field set to 1)."""
    raw = open(PATH, "rb").read()
    at = raw.rindex(b"\x18\x02 \x80\xfa\x01")
    return sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2:])


def test_fold_equals_the_library(spark):
    sp = best_path_library()
    d = "/root/testdata/sf0.001"
    words = sorted({w for r in spark.read.parquet(f"{d}/documents.parquet").select("text").collect() for w in r.text.split()})[:4000]
    pieces = M.load_pieces(PATH)
    covered = [w for w in words if all(c in pieces.search for c in w) and M.SPACE not in w]
    assert len(covered) > 1000
    got = {}
    for r in M.encode_units(spark.createDataFrame([(M.SPACE + w,) for w in covered if len(w) < 60], "unit string"), pieces).collect():
        got[r.unit] = list(r.ids)
        assert got[r.unit] == M.viterbi(r.unit, pieces)
    for w in covered:
        assert got[M.SPACE + w] == sp.encode(w), w


def test_documents_round_trip(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(HARD)] + [(None, "a b", "x"), (0, "", "x")], "doc_id long, text string, ids string")
    encoded = M.encode_documents(df, PATH)
    texts = [(str(r.doc_id), r.text) for r in M.decode_documents(encoded, PATH).collect()]
    assert sorted(texts) == sorted([(str(i), t or "") for i, t in enumerate(HARD)] + [("None", "a b"), ("0", "")])
    pieces = M.load_pieces(PATH)
    for r in encoded.where("doc_id is not null").collect():
        t = HARD[r.doc_id] or ""
        want = M.viterbi(M.SPACE + t.replace(" ", M.SPACE), pieces) if t else []
        assert np.frombuffer(r.ids, "<u4").tolist() == want, t[:40]
    assert M.encode_documents(df.limit(0), PATH).count() == 0


def test_query_round_trip(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = M.op10_sentencepiece_lattice(spark, d).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r.decoded_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.decoded_chars == len(texts[r.doc_id]) and r.n_ids > 0


def test_whole_texts_equal_the_library(spark):
    """Runs of spaces give the library's ids; elsewhere no path of the library's has a greater sum (`▁the` for `▁t`, `he` has a smaller one)."""
    sp, pieces = best_path_library(), M.load_pieces(PATH)
    runs = ["a   b", "x  ", "    return x", "a\n\n        if x:\n\t\ty  \n", "x" + " " * 17 + "y", " " * 63 + "word", " " * 40 + "end", " " * 200,
            "  .  , ;", "a" + " " * 100 + "1", "  two  spaces ", "日本   語  ", "x   \n   \n"]
    texts = runs + [t for t in HARD if t]
    assert sp.encode("a   b", out_type=str) == ["▁a", "▁▁", "▁b"]
    score = dict(pieces.search.values())
    total = lambda ids: sum(score.get(i, pieces.fallback) for i in ids)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in M.encode_documents(df, PATH).collect():
        ids, want = np.frombuffer(r.ids, "<u4").tolist(), sp.encode(texts[r.doc_id])
        assert ids == want or (r.doc_id >= len(runs) and total(ids) > total(want)), texts[r.doc_id][:40]


def test_each_unit_enters_the_lattice_once(spark, monkeypatch):
    """Blocks that share their words do not build its lattice again, and the shuffled documents are smaller than their text."""
    monkeypatch.setattr(M, "BLOCK_BYTES", 3_000)
    lattice, given = M.edges_of, []
    monkeypatch.setattr(M, "edges_of", lambda units, pieces: given.append(units) or lattice(units, pieces))
    said = "the cat sat on a mat, 龘 été 12.5\n  and   so on ".split(" ")
    texts = [" ".join(said[k % 9:] + said[:k % 9] + [f"w{k % 50}ord"]) for k in range(400)] + [None, "", "a b", "a b"]
    df = spark.createDataFrame([(k if k % 7 else None, t) for k, t in enumerate(texts)], "doc_id long, text string")
    pieces = M.load_pieces(PATH)
    want = [(k if k % 7 else None, np.array(M.viterbi(M.escaped(t), pieces), "<u4").tobytes()) for k, t in enumerate(texts)]
    got = [(r.doc_id, bytes(r.ids)) for r in M.encode_documents(df, PATH).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    rows = given[0].collect()
    assert len(rows) == len({r.unit for r in rows}) and max(len(set(r.blocks)) for r in rows) > 4
    table = pa.table({"block": pa.array([0] * 404, pa.int32()), "doc_id": pa.nulls(404, pa.string()), "text": texts})
    lots = list(M._dealt(iter(table.to_batches())))
    assert len(lots) == 1 and 4 * len(lots[0]["packed"][0].as_py()) < sum(len(t or "") for t in texts)


def test_edges_come_in_batches_of_any_size(spark, monkeypatch):
    pieces = M.load_pieces(PATH)
    units = sorted({u for t in HARD for u in M._UNIT.findall(M.escaped(t))} | {"▁" + "ab龘é" * 30})
    edges = M.edges_of(spark.createDataFrame([(u,) for u in units], "unit string").repartition(1), pieces).toArrow()

    class Shared:
        value = pieces

    handed_on = lambda units, ids, sizes: pa.record_batch({"unit": units["unit"].combine_chunks(), "ids": [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]})
    for enough, rows in ((1, 1), (40, 7), (10_000, 1_000), (10_000_000, 1_000)):
        monkeypatch.setattr(M, "EDGES", enough)
        got = [r for b in M._folded(Shared, handed_on)(iter(edges.to_batches(max_chunksize=rows))) for r in b.to_pylist()]
        assert sorted(r["unit"] for r in got) == units
        assert all(r["ids"] == M.viterbi(r["unit"], pieces) for r in got)
    with pytest.raises(ValueError):
        M.fold(edges.take(pa.array(np.random.default_rng(1).permutation(len(edges)))), pieces)


def test_chunks_keep_the_units():
    texts = [*HARD, "a\n b", "x\n\n y", "▁", "a▁b", "\n", " \n ", "a  ", "é龘 b", "日本語 x日y"]
    for t in texts:
        assert [u for c in M.chunks(t) for u in M.units_of(c)] == M._UNIT.findall(M.escaped(t)), t
