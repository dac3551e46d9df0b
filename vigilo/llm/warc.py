"""WARC archives: writing response and revisit records, and a salvage reader.

Records are written by Spark's own text writer, one row per record with CRLF as
the line end, which is exactly the record's closing blank line; so archives land
in any file system Spark can write to. The reader checks every record; after a
failed check it searches for the next valid gzip member or version line, goes on
from there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm.common import scratch_path, staged, table

CRLF = "\r\n"
#: Payloads below this size are always written in full.
REVISIT_BYTES = 1000
#: Records per archive file by their size class, the largest record in bytes: files stay below 128 MB, but that a record
#: of more than 16 MB has a file of its own. So a reader task holds no more.
FILE_RECORDS = {1 << 16: 2000, 1 << 20: 128, 1 << 24: 8, 1 << 31: 1}
GZIP_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_NAME = re.compile(rb"[A-Za-z0-9-]+\Z")

RECORD_SCHEMA = ("file string, kind string, start long, stop long, member_offset long, record_type string, record_id string, "
                 "target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary, reason string")


def _hex(column: Column) -> Column:
    return F.sha1(column)


def records(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html, ...)`` -> page_id, record (binary, without its closing CRLF CRLF).

    Of rows with equal payloads of REVISIT_BYTES or more, those with the largest
    page_id are responses, the others revisits of it; smaller payloads and rows
    with a null page_id are always responses. Only ids and digests are
    shuffled to find the revisits; they are written down first, so that Spark knows
    their size when the pages meet them by page_id and digest: few are sent to
    the pages, many are joined by a shuffle.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", _hex(F.col("payload")))
    large = rows.where((F.col("bytes") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest")
    target = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low")).where("low < refers_to")
    revisit = (large.join(target, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct())
    rows = rows.join(staged(revisit, "revisits"), ["page_id", "digest"], "left")
    head = lambda *kv: F.concat(*[x for k, v in kv for x in (F.lit(f"{k}: "), v, F.lit(CRLF))])
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    own = F.col("refers_to").isNull()
    http = F.encode(F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                             F.col("bytes").cast("string"), F.lit(CRLF * 2)), "UTF-8")
    block = F.concat(http, F.when(own, F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8")))
    common = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        head(("WARC-Type", F.when(own, F.lit("response")).otherwise(F.lit("revisit"))), ("WARC-Record-ID", name(F.col("page_id"))),
             ("WARC-Date", F.lit("1970-01-01T00:00:00Z")), ("WARC-Target-URI", uri),
             ("Content-Type", F.lit("application/http; msgtype=response")),
             ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
             ("WARC-Payload-Length", F.col("bytes").cast("string"))),
        F.when(own, F.lit("")).otherwise(head(
            ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ("WARC-Refers-To", name(F.col("refers_to"))))),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF * 2))
    return rows.select("page_id", F.concat(F.encode(common, "UTF-8"), block).alias("record"))


def write_archives(record_rows: DataFrame, path: str) -> None:
    """Write ``record`` (binary) rows as WARC files below ``path``, one write for every size class that has records."""
    closed = F.concat(F.col("record"), F.encode(F.lit(CRLF), "UTF-8")).cast("string")  # bytes as they are; the line end adds CRLF
    size = F.octet_length("record")
    bounds = list(zip([-1, *FILE_RECORDS], FILE_RECORDS))
    has = record_rows.agg(*[F.max((size > low) & (size <= high)).alias(str(high)) for low, high in bounds]).first()
    for n, (low, high) in enumerate(b for b in bounds if has[str(b[1])] or not any(has) and b[0] < 0):
        (record_rows.where((size > low) & (size <= high)).select(closed.alias("value")).write.mode("append" if n else "errorifexists")
         .option("lineSep", CRLF).option("maxRecordsPerFile", FILE_RECORDS[high]).text(path))


def _header(data: bytes, at: int):
    """(fields, block offset) of the record at ``at``, or a reason why there is none."""
    m = _VERSION.match(data, at)
    if not m:
        return None, "no version line"
    end = data.find(b"\r\n\r\n", m.end() - 2)
    if end < 0:
        return None, "header not ended"
    fields = {}
    for line in data[m.end():end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not _NAME.match(name):
            return None, "bad header line"
        fields[name.decode().lower()] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit() or not fields.get("warc-type"):
        return None, "bad or missing field"
    return fields, end + 4


def _checked(data: bytes, at: int):
    """(record fields dict, end) when the record at ``at`` passes every check, else (None, reason)."""
    fields, body = _header(data, at)
    if fields is None:
        return None, body
    stop = body + int(fields["content-length"])
    if stop > len(data):
        return None, "block cut off"
    if data[stop:stop + 4] != b"\r\n\r\n":
        return None, "no record end after the block"
    block, kind = data[body:stop], fields["warc-type"]
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        split = block.find(b"\r\n\r\n")
        if split < 0:
            return None, "no end of the http header"
        payload = block[split + 4:]
    scheme, _, digest = fields.get("warc-payload-digest", "").partition(":")
    digest = _sha1_hex(digest) if scheme.lower() == "sha1" else None
    if kind != "revisit":
        import hashlib

        own = hashlib.sha1(payload).hexdigest()
        if digest is not None and digest != own:
            return None, "payload digest differs"
        digest, size = own, len(payload)
    else:
        given = fields.get("warc-payload-length", "")
        size, payload = int(given) if given.isdigit() else None, None
    return {"record_type": kind, "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields.get("warc-refers-to"), "payload_bytes": size, "payload_digest": digest, "payload": payload}, stop + 4


def _sha1_hex(digest: str) -> str | None:
    """A SHA-1 digest written in hex or base 32, as lower-case hex."""
    import base64
    import binascii

    if re.fullmatch("[0-9A-Fa-f]{40}", digest):
        return digest.lower()
    try:
        return base64.b32decode(digest.upper()).hex()
    except binascii.Error:
        return "unreadable"


def _plain(data: bytes):
    """Records and gaps of uncompressed bytes: ('record' | 'gap', start, stop, fields or reason)."""
    at, size = 0, len(data)
    while at < size:
        fields, end = _checked(data, at)
        if fields is not None:
            yield "record", at, end, fields
            at = end
            continue
        reason, seek = end, at + 1
        while True:  # the next version line at which a whole record passes
            m = _VERSION.search(data, seek)
            if m is None:
                yield "gap", at, size, reason
                return
            if _checked(data, m.start())[0] is not None:
                yield "gap", at, m.start(), reason
                at = m.start()
                break
            seek = m.start() + 1


def _member(data: bytes, at: int):
    """(content, end) of the gzip member at ``at``; end is None when it breaks off, with what could be decoded before."""
    import zlib

    z, out, pos = zlib.decompressobj(31), [], at
    try:
        while not z.eof and pos < len(data):
            out.append(z.decompress(data[pos:pos + 65536]))
            pos += 65536
    except zlib.error:
        return b"".join(out), None
    return b"".join(out), min(pos, len(data)) - len(z.unused_data) if z.eof else None


def _members(data: bytes):
    """Gzip members: (offset, end, content, whole); a quarantined stretch is not whole and may have some content."""
    at, size = 0, len(data)
    while at < size:
        content, end = _member(data, at) if data.startswith(GZIP_MAGIC, at) else (b"", None)
        if end is not None:
            yield at, end, content, True
            at = end
            continue
        seek = data.find(GZIP_MAGIC, at + 1)
        while seek >= 0 and _member(data, seek)[1] is None:
            seek = data.find(GZIP_MAGIC, seek + 1)
        yield at, seek if seek >= 0 else size, content, False
        at = seek if seek >= 0 else size


def salvage(data: bytes) -> Iterator[tuple]:
    """('record' | 'gap', start, stop, member offset or None, fields or reason) of one archive, plain or gzipped.

    Offsets of records in a member count within its content; a bad stretch
    between members is a gap of the file itself (member offset None).
    """
    if data[:3] == GZIP_MAGIC or (not _VERSION.match(data) and GZIP_MAGIC in data and not _VERSION.search(data)):
        for start, end, content, whole in _members(data):
            for kind, a, b, what in _plain(content):
                yield kind, a, b, start, what
            if not whole:
                yield "gap", start, end, None, "bad gzip member"
    else:
        for kind, a, b, what in _plain(data):
            yield kind, a, b, None, what


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    for df in batches:
        for path, data in zip(df["path"], df["content"]):
            rows = []
            for kind, start, stop, member, what in salvage(data):
                fields = what if kind == "record" else {"reason": what}
                rows.append({"file": path, "kind": kind, "start": start, "stop": stop, "member_offset": member, **fields})
                if len(rows) == 500:
                    yield pd.DataFrame(rows, columns=columns, dtype=object)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns, dtype=object)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All archives below ``path`` -> one row per record (kind 'record') and per quarantined stretch (kind 'gap').

    Columns: file, kind, start, stop, member_offset, record_type, record_id,
    target_uri, refers_to, payload_bytes, payload_digest (lower-case hex SHA-1),
    payload, reason. A record is returned only when all its checks pass: version
    line, header lines, lengths, record end and payload digest. Empty files
    give no rows. A file is read as one value, so it must be below 2 GB; large
    archives should be split at record bounds (write_archives bounds its files).
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_read, RECORD_SCHEMA)


def page_records(read: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records that were read back."""
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return (read.where("kind = 'record'")
            .select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    page("refers_to").alias("refers_to")))


def op1_warc_salvage(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write_archives(records(table(spark, sf_dir, "pages")), path)
    return page_records(read_archives(spark, path))


ORACLE = """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b)::bigint as payload_bytes, sha1(b) as payload_digest from p),
t as (select payload_digest, max(page_id) as top from d where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id < top then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id < top then top end as refers_to
from d left join t using (payload_digest)
"""
