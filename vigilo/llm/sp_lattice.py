"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units that no piece of the table crosses (before every run
of escaped spaces, between Latin letters and other characters, around line ends).
The distinct units of the whole table become a lattice, once: bounded-length
substrings are exploded and equi-joined to the piece table, and the edges of
many units at a time are folded by Viterbi, position by position.

Documents lie in blocks, hash partitions of about BLOCK_BYTES of text, and are
shuffled once, compressed. Each block sends its distinct units to the lattice
with its number and gets their ids back (which spell the units), and its documents look
their units up there.

The segmentation is the one of greatest summed piece score (ties: the longer
last piece), which is how the library decodes a unigram model; a table taken
from a BPE model is read the same way, by its scores. Characters without a
piece of their own become byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilo.llm.common import table

SPACE = "▁"
LATIN = "A-Za-zÀ-ÖØ-öø-ɏḀ-ỿ"
UNIT = f"{SPACE}*[{LATIN}]+|{SPACE}*[^{LATIN}{SPACE}\\n]+|{SPACE}+|\\n"
_UNIT, _CHUNK = re.compile(UNIT), re.compile(f"{SPACE}+[^{SPACE}]*")
#: Longer units are folded where they are looked up (the same fold, in linear memory).
MAX_UNIT = 64
BLOCK_BYTES = 12 << 20
#: Text that a task gathers before it packs it by block.
PACK_BYTES = 16 << 20
#: Edges that are folded at a time.
EDGES = 250_000
MODEL = "piece_bpe_32k.model"


@dataclass(frozen=True)
class Pieces:
    """The piece table: searchable pieces with id and score, surface bytes of every id, id of byte 0, fallback score."""
    search: dict
    surface: list
    byte0: int
    fallback: float

    @property
    def longest(self) -> int:
        return max(map(len, self.search))


def load_pieces(model_file: str) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    search, surface, byte0 = {}, [], None
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte0 = i if byte0 is None else byte0
            surface.append(bytes([i - byte0]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            surface.append(b"")
        else:
            surface.append(piece.replace(SPACE, " ").encode())
            search[piece] = (i, float(sp.get_score(i)))
    if byte0 is None:
        raise ValueError("the piece table has no byte pieces")
    unit = re.compile(UNIT)
    crossing = [p for p in search if len(unit.findall(p)) != 1]
    if crossing:
        raise ValueError(f"pieces cross the units' bounds: {crossing[:5]}")
    return Pieces(search, surface, byte0, min(s for _, s in search.values()) - 10)


def escaped(text: str | None) -> str:
    """The text as the lattice sees it: a space in front, spaces escaped (null or empty: nothing)."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def key_of(cut: str) -> str:
    """An escaped unit or chunk without its space in front if that is a single one; with one if it has none."""
    return SPACE + cut if cut[0] != SPACE else cut[1:] if cut[1:2] not in ("", SPACE) else cut


def chunks(text: str | None) -> list[str]:
    """Keys of what the text is cut into before every run of spaces. No unit crosses a cut."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
        return list(map(key_of, _CHUNK.findall(escaped(text))))
    return text.split(" ")


def units_of(chunk: str) -> list[str]:
    """Units of a chunk given by its key."""
    return _UNIT.findall(chunk if chunk[0] == SPACE else SPACE + chunk)


def edges_of(units: DataFrame, pieces: Pieces) -> DataFrame:
    """``units(..., unit)`` -> the lattice: s, e, score, id of every edge; the columns of ``units`` on a unit's first edge, else null.

    The id of an edge without a piece (one character) is -1 - its code point. Exploding and a broadcast join keep the
    order of rows, so a unit's edges stand together, by start, then end (``fold`` makes sure of it).
    """
    # A vocabulary file bounds this table (tens of thousands of rows), so it is broadcast.
    known = F.broadcast(units.sparkSession.createDataFrame([(p, i, s) for p, (i, s) in pieces.search.items()],
                                                           "piece string, id int, score double"))
    carried = [c for c in units.columns if c != "unit"]
    spread = (units.withColumn("s", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)))
              .withColumns({c: F.when(F.col("s") == 0, F.col(c)) for c in carried})
              .withColumn("e", F.explode(F.sequence(F.col("s") + 1, F.least(F.col("s") + pieces.longest, F.length("unit")))))
              .withColumn("piece", F.substring("unit", F.col("s") + 1, F.col("e") - F.col("s"))))
    edges = spread.join(known, "piece", "left").where(F.col("id").isNotNull() | (F.col("e") == F.col("s") + 1))
    first = (F.col("s") == 0) & (F.col("e") == 1)
    return edges.select("s", "e", F.coalesce("score", F.lit(pieces.fallback)).alias("score"),
                        F.coalesce("id", -1 - F.ascii("piece")).alias("id"), *(F.when(first, F.col(c)).alias(c) for c in units.columns))


def fold(edges: pa.Table, pieces: Pieces):
    """Viterbi over the edges of whole units: (rows of the units' first edges, all their ids in a row, how many each has)."""
    import numpy as np

    s, e, score, piece = (edges[c].to_numpy() for c in ("s", "e", "score", "id"))
    first = np.flatnonzero((s == 0) & (e == 1))
    of = np.repeat(np.arange(len(first)), np.diff(first, append=len(s)))
    length = np.maximum.reduceat(e, first)
    in_order = (s[1:] > s[:-1]) | ((s[1:] == s[:-1]) & (e[1:] > e[:-1])) | (of[1:] > of[:-1])
    if not in_order.all() or edges["unit"].null_count != len(s) - len(first):
        raise ValueError("the edges of a unit do not stand together")

    # Positions of all units in a row; edges by end, then start: of each step, a unit has one edge at most.
    base = np.cumsum(length + 1) - (length + 1)
    step = e * pieces.longest + (pieces.longest - (e - s))
    order = np.argsort(step.astype(np.uint16) if step.max() < 1 << 16 else step, kind="stable")
    step, score, piece = step[order], score[order], piece[order]
    start, end = (base[of] + s)[order], (base[of] + e)[order]
    best, back = np.full(base[-1] + length[-1] + 1, -np.inf), np.zeros(base[-1] + length[-1] + 1, np.int64)
    best[base] = 0.0
    bounds = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(step)]
    for a, b in zip(bounds, bounds[1:]):
        total, to = best[start[a:b]] + score[a:b], end[a:b]
        better = np.flatnonzero(total > best[to])
        best[to[better]], back[to[better]] = total[better], better + a

    # The best edges from the end on, then in the order of the text.
    at, unit, path = base + length, np.arange(len(first)), []
    while len(at):
        taken = back[at]
        path.append((unit, taken))
        left = start[taken] > base[unit]
        at, unit = start[taken][left], unit[left]
    unit, taken = (np.concatenate(x[::-1]) for x in zip(*path))
    by_unit = np.argsort(unit, kind="stable")
    unit, ids = unit[by_unit], piece[taken[by_unit]]
    lone = np.flatnonzero(ids < 0)
    as_bytes = [chr(-1 - i).encode("utf-8", "surrogatepass") for i in ids[lone].tolist()]
    many = np.ones(len(ids), np.int64)
    many[lone] = [len(raw) for raw in as_bytes]
    out, places = np.repeat(ids, many), np.cumsum(many) - many
    for k, raw in zip(places[lone].tolist(), as_bytes):
        out[k:k + len(raw)] = [b + pieces.byte0 for b in raw]
    return first, out, np.bincount(unit, many, len(first)).astype(np.int64)


def _folded(shared, handed_on):
    """Folds a stream of edges; ``handed_on(units, ids, sizes)`` makes a record batch of each gathered lot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def lot(edges: pa.Table) -> pa.RecordBatch:
            first, ids, sizes = fold(edges, shared.value)
            return handed_on(edges.drop_columns(["s", "e", "score", "id"]).take(pa.array(first)).combine_chunks(), ids, sizes)

        held, rows, enough = [], 0, EDGES
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= enough:
                edges = pa.Table.from_batches(held)
                last = int(np.flatnonzero((edges["s"].to_numpy() == 0) & (edges["e"].to_numpy() == 1))[-1])  # this unit may go on
                if last:
                    yield lot(edges.slice(0, last))
                held = edges.slice(last).to_batches()
                rows -= last
                enough = max(EDGES, 2 * rows)
        if rows:
            yield lot(pa.Table.from_batches(held))
        held = []
        pa.default_memory_pool().release_unused()  # the worker lives on

    return run


def encode_units(units: DataFrame, pieces: Pieces) -> DataFrame:
    """``units(..., unit)`` -> ``(..., unit, ids array<int>)`` by the lattice and its fold, one row per input row."""
    def handed_on(units: pa.Table, ids, sizes) -> pa.RecordBatch:
        import numpy as np

        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(ids, pa.int32()))
        return units.append_column("ids", lists).to_batches()[0]

    shared = units.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*units.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return edges_of(units, pieces).mapInArrow(_folded(shared, handed_on), schema)


def viterbi(unit: str, pieces: Pieces) -> list[int]:
    """The same fold for one unit in plain Python (long units; also the tests' reference)."""
    best, back, longest = [0.0], [None], pieces.longest
    for e in range(1, len(unit) + 1):
        top = None
        for s in range(max(0, e - longest), e):
            hit = pieces.search.get(unit[s:e])
            if hit is None and e - s == 1:
                hit = (None, pieces.fallback)
            if hit and (top is None or best[s] + hit[1] > top[0]):
                top = (best[s] + hit[1], s, hit[0])
        best.append(top[0])
        back.append(top[1:])
    out, e = [], len(unit)
    while e:
        s, i = back[e]
        out.append([i] if i is not None else [b + pieces.byte0 for b in unit[s:e].encode("utf-8", "surrogatepass")])
        e = s
    return [i for part in reversed(out) for i in part]


def decode(ids, pieces: Pieces) -> str:
    """Text of ids: surfaces joined, the space in front taken off."""
    raw = b"".join(map(pieces.surface.__getitem__, ids))
    return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(column: pa.ChunkedArray) -> Iterator[pa.Table]:
    for raw in column:
        yield pa.ipc.open_stream(raw.as_buffer()).read_all().combine_chunks()


def _lots(blocks, rows: pa.Table, of=None) -> pa.RecordBatch:
    """One row for each block: its number, its rows packed. Row k of ``of`` (else of ``rows``) goes to ``blocks[k]``."""
    import numpy as np

    order = np.argsort(blocks, kind="stable")
    bounds = np.flatnonzero(np.diff(blocks[order], prepend=-1))
    lots = np.split(order if of is None else of[order], bounds[1:])
    return pa.RecordBatch.from_arrays([pa.array(blocks[order][bounds], pa.int32()),
                                       pa.array([_packed(rows.take(pa.array(x))) for x in lots], pa.binary())], names=["block", "packed"])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, doc_id, text) -> (block, packed documents)."""
    def handed_on() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        return _lots(rows["block"].to_numpy(), rows.select(["doc_id", "text"]))

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size > PACK_BYTES:
            yield handed_on()
            held, size = [], 0
    if held:
        yield handed_on()
    held = []
    pa.default_memory_pool().release_unused()  # the worker lives on


def _units(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
    """The distinct units of a block, in order (they shuffle smaller). Longer ones than MAX_UNIT stay out."""
    seen, units = set(), set()
    for part in _unpacked(docs["packed"]):
        for text in part["text"].to_pylist():
            seen.update(chunks(text))
    for chunk in seen:
        units.update(units_of(chunk))
    found = sorted(u for u in units if len(u) <= MAX_UNIT)
    return pa.table({"block": pa.array([key[0].as_py()] * len(found), pa.int32()), "unit": pa.array(found, pa.string())})


def _to_blocks(units: pa.Table, ids, sizes) -> pa.RecordBatch:
    """Folded units (blocks, unit) -> for each block, the ids of its units packed."""
    import numpy as np

    narrow = pa.uint16() if ids.max() < 1 << 16 else pa.uint32()
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(ids).cast(narrow))
    blocks = pa.concat_arrays(units["blocks"].chunks)
    of = np.repeat(np.arange(len(units)), np.diff(blocks.offsets.to_numpy()))
    return _lots(blocks.flatten().to_numpy(), pa.table({"ids": lists}), of)


class _Ids(dict):
    """Ids, as bytes, by the keys of a block's units and chunks. Units that the lattice left out, the long ones, are folded here."""

    def __init__(self, known: pa.ChunkedArray, pieces: Pieces):
        self.pieces = pieces
        for part in _unpacked(known):
            lists = part["ids"].chunk(0)
            cuts, flat = lists.offsets.to_numpy().tolist(), lists.values.to_numpy()
            surfaces, raw = list(map(pieces.surface.__getitem__, flat.tolist())), flat.astype("<u4").tobytes()
            for a, b in zip(cuts, cuts[1:]):
                self[key_of(b"".join(surfaces[a:b]).decode().replace(" ", SPACE))] = raw[4 * a:4 * b]

    def __missing__(self, chunk: str) -> bytes:
        import numpy as np

        parts = units_of(chunk)
        if len(parts) == 1 and len(parts[0]) <= MAX_UNIT:  # a unit that the lattice has not sent
            raise KeyError(chunk)
        ids = b"".join([np.array(viterbi(u, self.pieces), "<u4").tobytes() if len(u) > MAX_UNIT else self[key_of(u)] for u in parts])
        if len(chunk) <= MAX_UNIT:
            self[chunk] = ids
        return ids


def _assembled(shared):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, known: pa.Table) -> pa.Table:
        get, out = _Ids(known["packed"], shared.value).__getitem__, []
        for part in _unpacked(docs["packed"]):
            ids = pa.array((b"".join(map(get, chunks(text))) for text in part["text"].to_pylist()), pa.binary())
            out.append(pa.RecordBatch.from_arrays([part["doc_id"].combine_chunks(), ids], names=["doc_id", "ids"]))
        return pa.Table.from_batches(out, pa.schema([("doc_id", pa.string()), ("ids", pa.binary())]))

    return run


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, ids (binary, little-endian unsigned 32-bit), one row per input row.

    Null and empty texts have no ids. Repeated rows are encoded each, null ids
    stay null, extra columns are ignored, no rows give no rows. Rows are dealt by
    the hash of id and text, so no source or copy group gathers in one block
    beyond the rows that are equal in both.
    """
    pieces = load_pieces(model_file)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    dealt = rows.select(block.alias("block"), "doc_id", "text").mapInArrow(_dealt, "block int, packed binary").repartition("block")
    units = (dealt.groupBy("block").applyInArrow(_units, "block int, unit string")
             .repartition(blocks, "unit").groupBy("unit").agg(F.collect_list("block").alias("blocks")))
    known = edges_of(units, pieces).mapInArrow(_folded(shared, _to_blocks), "block int, packed binary")
    out = (dealt.groupBy("block").cogroup(known.toDF("block2", "packed").groupBy("block2"))
           .applyInArrow(_assembled(shared), "doc_id string, ids binary"))
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """``encoded(doc_id, ids, ...)`` -> doc_id, text. The exact inverse, but that U+2581 reads as a space."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_file))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for df in batches:
            yield pd.DataFrame({"doc_id": df["doc_id"], "text": [
                decode(np.frombuffer(x, "<u4").tolist() if x is not None else (), shared.value) for x in df["ids"]]})

    out = encoded.select(F.col("doc_id").cast("string"), "ids").mapInPandas(run, "doc_id string, text string")
    return out.withColumn("doc_id", F.col("doc_id").cast(encoded.schema["doc_id"].dataType))


def op10_sentencepiece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as digests, and the digest of what they decode to (equal to the text's own)."""
    import public_tokenizers

    encoded = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
    shared = spark.sparkContext.broadcast(load_pieces(public_tokenizers.path(MODEL)))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        import numpy as np

        def digest(raw: pa.Buffer) -> tuple:
            text = decode(np.frombuffer(raw, "<u4").tolist(), shared.value)
            return len(raw) // 4, crc32(raw), len(text), crc32(text.encode("utf-8", "replace"))

        for batch in batches:
            found = list(zip(*(digest(x.as_buffer()) for x in batch.column("ids")))) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in found)],
                                             names=["doc_id", "n_ids", "ids_crc32", "decoded_chars", "decoded_crc32"])

    columns = "doc_id long, n_ids long, ids_crc32 long, decoded_chars long, decoded_crc32 long"
    return encoded.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(digests, columns)
