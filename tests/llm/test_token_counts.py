"""Token counts against the installed library itself, on whole texts."""
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from vigilo.llm import token_counts
from vigilo.llm.token_counts import PreTokens, count_tokens, parting

FILE = public_tokenizers.path(token_counts.MODEL)
SF = "/root/testdata/sf0.001"

HARD = [
    "", " ", "  ", "a", " a", "a ", "a  b", " a  b\n\nc ", "\n", "\t\tx\r\n", "<s>x</s><unk><0x0A>", "a\0b", "▁", "a▁b ▁ c", "▁▁▁a",
    "naïve café — “quoted” …", "Привет, мир!", "数据获取一个 你好，世界", "مرحبا العالم", "é ﬁ Ａ ½", "🙂🙃 a🙂b", "1234567 3.14159 0x1F",
    "x" * 5000, "ab" * 3000, " " * 4000, "a" + " " * 77 + "b", "don't can't it's", "foo_bar.baz(qux[0])->y;", "═══──═",
]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def expected(texts):
    sp = library()
    return [(len((t or "").encode()), len(sp.encode(t or ""))) for t in texts]


def test_pre_tokens_part_texts_without_changing_their_count():
    parts, sp, rng = PreTokens(open(FILE, "rb").read()), library(), random.Random(3)
    alphabet = list("aeiou trnsl   ,.'-()09\n▁éßжя数据的🙂\t") + ["th", "ing ", "  ", "</s>"]
    texts = HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for t in texts:
        keys, long, _ = parts.parts(parts.words([t]).flatten())
        full = [x or k for k, x in zip(keys.to_pylist(), long.to_pylist())]
        assert sum(parts.pieces(full)) == len(sp.encode(t)), repr(t[:80])
        assert sorted("".join(full)) == sorted(sp.normalize(t) if t else "")


def test_no_piece_lies_across_a_border():
    parts = PreTokens(open(FILE, "rb").read())
    sp = library()
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            assert len(parts.found.findall(sp.id_to_piece(i))) == 1


def test_pieces_over_a_space_are_refused():
    with pytest.raises(ValueError):
        parting(["ab", "a▁b"])


@pytest.mark.parametrize("heavy", [0, 50, 100_000])
def test_whole_table_equals_the_library(spark, monkeypatch, heavy):
    """With HEAVY = 0 every pre-token goes through the shuffled join, else through the broadcast."""
    monkeypatch.setattr(token_counts, "HEAVY", heavy)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in count_tokens(docs, FILE).collect()}
    assert len(got) == len(rows)
    for r, (n_bytes, n) in zip(rows, expected([r["text"] for r in rows])):
        assert (got[r["doc_id"]]["n_bytes"], got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["over_limit"]) == (n_bytes, n, n > 4096)


@pytest.mark.parametrize("heavy", [0, 100_000])
def test_hard_texts_long_pre_tokens_and_a_full_gathering(spark, monkeypatch, heavy):
    monkeypatch.setattr(token_counts, "HEAVY", heavy)
    monkeypatch.setattr(token_counts, "SLICE", 7)
    monkeypatch.setattr(token_counts, "GATHERED", 10)
    got = {r["doc_id"]: r for r in count_tokens(frame(spark, list(enumerate(HARD))), FILE, limit=100).collect()}
    for i, (n_bytes, n) in enumerate(expected(HARD)):
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (n_bytes, n, n > 100), HARD[i][:40]


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (2, "same words"), (2, "same words"), (None, "no id"), (None, None)]
    docs = frame(spark, rows).withColumns({"key": F.lit("k"), "row": F.lit(0), "uses": F.lit(1), "rest": F.lit(None).cast("int")})
    out = count_tokens(docs, FILE)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    want = [(i, b, n, False) for (i, _), (b, n) in zip(rows, expected([t for _, t in rows]))]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert count_tokens(frame(spark, []), FILE).collect() == []
