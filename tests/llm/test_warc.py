"""WARC: round trip, revisits, salvage of damaged archives, odd inputs."""

import gzip
import hashlib

import duckdb

from vigilo.llm import warc as M


def record(i, payload, **extra):
    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{i}>", "Content-Type": "application/http; msgtype=response",
              "WARC-Payload-Digest": "sha1:" + hashlib.sha1(payload).hexdigest(), "Content-Length": str(len(http + payload)), **extra}
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + http + payload + b"\r\n\r\n"


def ids(data):
    return [x[4]["record_id"] for x in M.salvage(data) if x[0] == "record"]


def gaps(data):
    return [(x[1], x[2]) for x in M.salvage(data) if x[0] == "gap" and x[3] is None]


def test_salvage_plain():
    a, b, c = (record(i, bytes([65 + i]) * 50) for i in range(3))
    assert ids(a + b + c) == [f"<urn:page:{i}>" for i in range(3)] and gaps(a + b + c) == []
    broken = b.replace(b"B" * 50, b"B" * 49 + b"X")                       # digest fails
    assert ids(a + broken + c) == ["<urn:page:0>", "<urn:page:2>"] and gaps(a + broken + c) == [(len(a), len(a + b))]
    cut = a + b[:-20] + c                                                 # block cut short
    assert ids(cut) == ["<urn:page:0>", "<urn:page:2>"] and gaps(cut) == [(len(a), len(cut) - len(c))]
    assert ids(b"junk" + a) == ["<urn:page:0>"] and gaps(b"junk" + a) == [(0, 4)]
    assert ids(a + b[:30]) == ["<urn:page:0>"] and gaps(a + b[:30]) == [(len(a), len(a) + 30)]
    nested = record(9, b"text WARC/1.0\r\nWARC-Type: x\r\n\r\n more")       # a version line inside a payload
    assert ids(nested + a) == ["<urn:page:9>", "<urn:page:0>"]
    assert ids(b"") == [] and gaps(b"") == []
    assert ids(record(1, b"") + a) == ["<urn:page:1>", "<urn:page:0>"]


def test_salvage_members():
    parts = [gzip.compress(record(i, bytes([65 + i]) * 500)) for i in range(4)]
    assert ids(b"".join(parts)) == [f"<urn:page:{i}>" for i in range(4)]
    bad = bytearray(b"".join(parts))
    at = len(parts[0]) + 40
    bad[at:at + 6] = b"\0" * 6
    assert ids(bytes(bad)) == ["<urn:page:0>", "<urn:page:2>", "<urn:page:3>"]
    assert gaps(bytes(bad)) == [(len(parts[0]), len(parts[0] + parts[1]))]
    assert ids(b"".join(parts)[:-10]) == [f"<urn:page:{i}>" for i in range(3)]


def test_records_before_the_damage_in_a_member_are_kept():
    import random
    noise = random.Random(1).randbytes(200_000)
    whole = gzip.compress(b"".join(record(i, noise[i * 20_000:(i + 1) * 20_000]) for i in range(10)))
    assert ids(whole[:len(whole) // 2])[:3] == ["<urn:page:0>", "<urn:page:1>", "<urn:page:2>"]
    assert gaps(whole[:len(whole) // 2]) == [(0, len(whole) // 2)]


def test_query_equals_duckdb(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{d}/pages.parquet'")
    want = sorted(map(str, con.execute(M.ORACLE).fetchall()))
    got = M.op1_warc_salvage(spark, d).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_revisits_and_odd_rows(spark, tmp_path):
    long, short = "ä" * 500, "a" * 999
    odd = "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    df = spark.createDataFrame(
        [(1, "u 1", long, 0), (5, None, long, 0), (3, "u", long, 0), (2, "u", short, 0), (4, "u", short, 0), (6, "u", None, 0), (7, "u", "", 0),
         (8, "u", odd, 0), (9, "u", odd * 50, 0), (5, None, long, 0), (None, "u", long, 0)], "page_id long, url string, html string, bytes int")
    path = str(tmp_path / "w")
    M.write_archives(M.records(df), path)
    read = M.read_archives(spark, path).cache()
    assert read.where("kind = 'gap'").count() == 0
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in M.page_records(read).collect())
    n = len(odd)
    assert got == sorted([("1", 1000, "revisit", 5), ("3", 1000, "revisit", 5), ("5", 1000, "response", None), ("5", 1000, "response", None),
                          ("2", 999, "response", None), ("4", 999, "response", None), ("6", 0, "response", None), ("7", 0, "response", None),
                          ("8", n, "response", None), ("9", 50 * n, "response", None), ("None", 1000, "response", None)])
    payloads = {r.record_id: bytes(r.payload) for r in read.where("payload is not null").collect()}
    assert payloads["<urn:page:9>"].decode() == odd * 50 and payloads["<urn:page:5>"].decode() == long
    empty = str(tmp_path / "e")
    M.write_archives(M.records(df.limit(0)), empty)
    assert M.read_archives(spark, empty).count() == 0


def test_files_are_bounded_by_bytes(spark, tmp_path):
    rows = [(i, f"u{i}", "x" * n + str(i)) for i, n in enumerate([10, 70_000, 70_000, 1_100_000, 17_000_000, 17_000_000, 0] + [500] * 2100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    M.write_archives(M.records(df), path)
    sizes = sorted((f.stat().st_size for f in (tmp_path / "w").glob("part-*")), reverse=True)
    assert len(sizes) == 6 and 17e6 < sizes[1] <= sizes[0] < 17.1e6
    assert sorted(r.payload_bytes for r in M.read_archives(spark, path).where("kind = 'record'").select("payload_bytes").collect()) == sorted(
        len(h) for _, _, h in rows)
