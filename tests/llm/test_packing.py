"""Packing: token ids against the tokenizer, exact cover, window sizes, odd inputs."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vigilo.llm import packing as M
from vigilo.llm import tokens

PATH = public_tokenizers.path(M.TOKENIZER)


def direct(texts):
    tok = Tokenizer.from_file(PATH)
    return [np.array(q.ids, "<u4").tobytes() for q in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


HARD = [
    "", None, "The CAT's don't we'LL (-.) a.b...c", "<|endoftext|> x<|startoftext|>y < |endoftext|>", "Ünïcode ß ẞ İ Σας ΟΔΟΣ ΟΔΟΣ.",
    "é ́x á! é́!", "tab\tnl\ncr\r vt\x0bff\x0c \x1cfs\x1d a\x1cb", "nbsp\xa0x y　z\x85w", "日本語 テスト。", "x" * 5000,
    "12 345 a1b2 !!! ??? *** %%% abc### QUE.!! it's 's", "ﬁ ﬂ Å ſ ǅ ŉ", "a'b 'tis rock'n'roll' '", "😀😀 a😀!", "\x00 \x7f ﻿ x",
]


def test_chunk_ids_equal_the_tokenizer():
    got = tokens.ChunkTokenizer(open(PATH, encoding="utf-8").read()).ids(HARD)
    for text, a, b in zip(HARD, got, direct(HARD)):
        assert a == b, text


@pytest.mark.parametrize("seed", range(6))
def test_pack_covers_every_token_once(seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([1, 2, rnd.randint(1, 300), rnd.randint(1, 3000), 2048, 4096, rnd.randint(1, 20000)]) for _ in range(seed * 60)]
    windows = M.pack(sizes)
    seen = defaultdict(list)
    for w in windows:
        size = sum(n for _, _, n in w)
        assert 0 < size <= M.WINDOW and size & (size - 1) == 0
        for d, s, n in w:
            seen[d].append((s, n))
    for d, n in enumerate(sizes):
        at = 0
        for s, k in sorted(seen[d]):
            assert s == at and k > 0
            at += k
        assert at == n
    full = sum(sum(p[2] for p in w) == M.WINDOW for w in windows)
    if sum(sizes) > 50_000:
        assert full * M.WINDOW > 0.8 * sum(sizes)


def check(rows, texts):
    ids = {k: x + (1).to_bytes(4, "little") for k, x in zip(texts, direct(texts.values()))}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for k, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[k]) // 4
            assert r.ids_crc32 == zlib.crc32(ids[k][4 * r.start:4 * (r.start + r.length)])
            at += r.length
        assert at == len(ids[k]) // 4
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= M.WINDOW and at & (at - 1) == 0 and all(r.sequence_tokens == at for r in own)


def test_query_on_documents(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = M.op6_hierarchical_packing(spark, d).collect()
    check(rows, texts)
    per_step = defaultdict(int)
    for r in rows:
        per_step[r.step_group] += r.length
    assert max(per_step.values()) - min(per_step.values()) <= 3 * M.WINDOW


def test_odd_rows(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(HARD)], "doc_id long, text string, length string")
    check(M.pack_documents(df.repartition(3), PATH).collect(), dict(enumerate(HARD)))
    same = spark.createDataFrame([(None, "a b"), (7, "c"), (7, "c"), (2 ** 60 + 1, None)], "doc_id long, text string").coalesce(1)
    out = M.pack_documents(same, PATH).collect()
    assert sorted(str(r.doc_id) for r in out if r.start == 0) == sorted(["None", "7", "7", str(2 ** 60 + 1)])
    assert M.pack_documents(df.limit(0), PATH).count() == 0
