"""Personal data: base spans against a plain regex scan, bootstrapped discovery, odd inputs."""

import hashlib
import re

from pyspark.sql import functions as F

from vigilo.llm import pii_bootstrap as M

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def only_digits(v):
    return re.sub("[^0-9]", "", v)


def brute(text):
    text = text or ""
    spans = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    spans += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", m.start(), m.end()) for m in CARD.finditer(text)
              if 14 <= len(only_digits(m[0])) <= 19 and luhn(only_digits(m[0]))]
    spans += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(only_digits(m[0])) <= 15]
    spans.sort(key=lambda x: (x[1], M.BASE.index(x[0])))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


TEXTS = [
    "", None, "no data here", "a@b.c_d@e.f", "x a.b+c@mail-1.example.co.uk. y@z @q.r a@b..c@d.e", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5 4111111111111111 41111111111111111111", "+1 (509) 555-6973, +12345 +49.30.123456789 +1 +22",
    "😀ñ +1 (509) 555-6973 😀 joe@x.org", "a" * 100_000 + " j@k.lm", "7" * 20_000, "1." * 3000, "j@k" + ".x" * 5000, "1 " * 3000,
    "4111 1111 1111 1111 4111 1111 1111 1111", "1--4111111111111111- 4111111111111111",
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, h string")


def read(df):
    return df.select("doc_id", M.S.written(F.col("base"), M.KINDS).alias("base"),
                     M.S.written(F.col("found"), M.KINDS).alias("found")).collect()


def test_base_spans_match_a_plain_scan(spark):
    got = {r.doc_id: r.base for r in read(M.scan(frame(spark, TEXTS)))}
    for i, t in enumerate(TEXTS):
        assert got[i] == brute(t), (i, (t or "")[:60])


def test_query_on_documents(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    out = M.op3_bootstrapped_pii(spark, d).collect()
    assert {r.doc_id: r.base_sha256 for r in out} == {k: hashlib.sha256(brute(t).encode()).hexdigest() for k, t in texts.items()}
    for r in out:
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len([x for x in brute(texts[r.doc_id]).split(",") if x])


def test_bootstrapping_discovers_only_behind_trusted_patterns(spark):
    seeds = [f"Some words. Call us at +1 (509) 555-{1000 + i} today please." for i in range(12)]
    unseen = "Some words. Call us at 0509/5551234 today please."
    mixed = [f"It was seen in code {10_000 + i} there." for i in range(12)] + [f"And in code +1 (509) 555-{2000 + i} too." for i in range(6)]
    texts = [*seeds, unseen, "Some number 0509/5551234 elsewhere.", *mixed, seeds[0], unseen]
    got = {r.doc_id: r.found for r in read(M.scan(frame(spark, texts)))}
    at = unseen.index("0509")
    assert got.pop(12) == got.pop(len(texts) - 1) == f"like_phone:{at}:{at + 12}"
    assert set(got.values()) == {""}


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "j@k.lm"), (1, "j@k.lm"), (None, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.base) for r in read(M.scan(df))) == [("1", "email:0:6"), ("1", "email:0:6"), ("None", "")]
    assert M.scan(df.limit(0)).count() == 0
