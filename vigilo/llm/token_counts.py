"""Token counts of whole texts: pieces counted once per distinct pre-token, joined to per-document frequencies, summed.

Pre-tokens come from the piece table itself. A merge only ever builds a piece
of the table, so between two neighbouring characters that stand side by side in
no piece there is always a token border; texts are parted there, and a text has
as many tokens as its pre-tokens have together. The library sees each distinct
pre-token once; no document's ids are ever built.

The join is split by frequency. The most used pre-tokens, ``HEAVY`` at most,
always fit a broadcast and are summed where the document is read; only the rarer
ones are shuffled, and as HEAVY others are used more, none of them is a hot key.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import staged, table
from vigilo.llm.tokens import worker_store

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: So many of the most used pre-tokens, of at most 71 characters each, are summed in place.
HEAVY = 100_000
#: Longer pre-tokens are known by a digest (a key longer than any short pre-token, so the two never meet).
LONG = 64
#: Texts that a task works on at a time: so many, or so many characters of them.
SLICE, SLICE_CHARS = 2_500, 8 << 20
#: Pre-tokens that a task gathers before it hands its counts on.
GATHERED = 1_000_000

_SPACE = "▁"
_CUT = re.compile(f"{_SPACE}+[^{_SPACE}]*|[^{_SPACE}]+")
# Model file fields 3 = normalizer: 2 = rules (none), 3 = dummy prefix, 4 = drop spaces (off). Appended fields override.
_AS_IT_IS = bytes([0x1A, 0x06, 0x12, 0x00, 0x18, 0x00, 0x20, 0x00])


def runs(pieces: list[str]) -> list[str]:
    """Regexes of the runs that pieces are made of, without leading spaces.

    Characters that stand side by side in a piece belong to one class, and a run
    is made of one class; characters that pieces only join to a space stand alone.
    """
    joined, behind_space = {}, set()

    def find(c: str) -> str:
        joined.setdefault(c, c)
        while joined[c] != c:
            joined[c] = c = joined[joined[c]]
        return c

    for piece in pieces:
        for a, b in zip(piece, piece[1:]):
            if a != _SPACE:
                if b == _SPACE:
                    raise ValueError("a piece joins a space to the character before it: texts cannot be parted at spaces")
                joined[find(a)] = find(b)
            elif b != _SPACE:
                behind_space.add(b)
    classes: dict[str, list[str]] = {}
    for c in sorted(joined):
        classes.setdefault(find(c), []).append(c)
    out = ["[{}]+".format("".join(map(re.escape, cs))) for cs in sorted(classes.values(), key=len, reverse=True)]
    lone = sorted(behind_space - set(joined))
    return out + (["[{}]".format("".join(map(re.escape, lone)))] if lone else [])


def parting(pieces: list[str]) -> str:
    """Regex of pre-tokens: no piece of the table holds two characters on both sides of a border.

    A pre-token is a run of escaped spaces with a run of one class behind it, or
    either alone, or one character that no piece joins to another.
    """
    return "|".join([f"{_SPACE}*{run}" for run in runs(pieces)] + [f"{_SPACE}+", "."])


class PreTokens:
    """``split(text)`` and ``pieces(pre_token)`` of a byte-fallback BPE model; built once per Python worker."""

    def __init__(self, model: bytes):
        import sentencepiece

        store = worker_store().setdefault("pre_tokens", {})
        if store.get("model") != model:
            whole = sentencepiece.SentencePieceProcessor(model_proto=model)
            if not any(whole.is_byte(i) for i in range(whole.get_piece_size())):
                raise ValueError("the model has no byte pieces: unknown characters in a row would count as one token")
            special = lambda i: whole.is_control(i) or whole.is_unknown(i) or whole.is_byte(i)
            usual = [whole.id_to_piece(i) for i in range(whole.get_piece_size()) if not special(i)]
            store.update(model=model, whole=whole, found=re.compile(parting(usual), re.DOTALL), run="^(?:{})$".format("|".join(runs(usual))),
                         part=sentencepiece.SentencePieceProcessor(model_proto=model + _AS_IT_IS))
        self.whole, self.found, self.run, self.part = store["whole"], store["found"], store["run"], store["part"]

    def words(self, texts: list[str]) -> pa.ListArray:
        """Each text cut before its runs of spaces. A word of one leading space is given without it, one without any with it."""
        whole = [self.whole.normalize(t) if t else "" for t in texts]
        odd = [i for i, w in enumerate(whole) if w[:1] != _SPACE or _SPACE * 2 in w]
        cuts = pc.split_pattern(pa.array([w[1:] for w in whole], pa.string()), _SPACE)
        if not odd:
            return cuts
        flip = lambda w: w if w[:2] == _SPACE * 2 else w[1:] if w[:1] == _SPACE else _SPACE + w
        own = pa.array([list(map(flip, _CUT.findall(whole[i]))) for i in odd], pa.list_(pa.string()))
        place = list(range(len(texts)))
        for k, i in enumerate(odd):
            place[i] = len(texts) + k
        return pa.concat_arrays([cuts, own]).take(pa.array(place))

    def parts(self, words: pa.StringArray):
        """Pre-tokens of ``words``: (keys, the full text of those whose key is a digest else null, word that each belongs to)."""
        import numpy as np

        one = pc.match_substring_regex(words, self.run)  # a run behind one space: no need to search it
        keys = pc.binary_join_element_wise(_SPACE, words.filter(one), "")
        at = np.flatnonzero(one.to_numpy(zero_copy_only=False))
        rest = np.flatnonzero(~one.to_numpy(zero_copy_only=False))
        more, of = [], []
        for i, w in zip(rest.tolist(), words.take(pa.array(rest)).to_pylist()):
            found = self.found.findall(w if w[:2] == _SPACE * 2 else w[1:] if w[:1] == _SPACE else _SPACE + w)
            more += found
            of += [i] * len(found)
        full = pa.concat_arrays([keys, pa.array(more, pa.string())])
        of = np.concatenate([at, np.array(of, np.int64)])
        long = pc.greater(pc.utf8_length(full), LONG)
        if not pc.any(long).as_py():
            return full, pa.nulls(len(full), pa.string()), of
        digests = pa.array([None if n is None else "sha256:" + sha256(n.encode()).hexdigest()
                            for n in pc.if_else(long, full, None).to_pylist()], pa.string())
        return pc.coalesce(digests, full), pc.if_else(long, full, None), of

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        return [len(ids) for ids in self.part.encode(pre_tokens, num_threads=1)]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) in bounded runs."""
    texts = [t or "" for t in batch.column("text").to_pylist()]
    first = held = 0
    for i, t in enumerate(texts):
        if i > first and (i - first >= SLICE or held + len(t) > SLICE_CHARS):
            yield first, texts[first:i]
            first, held = i, 0
        held += len(t)
    if texts:
        yield first, texts[first:]


def _uses(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, held, rows = PreTokens(model.value), [], 0

        def handed_on():
            found = pa.concat_tables(held).group_by(["key", "long"]).aggregate([("uses", "sum")])
            return found.rename_columns(["key", "long", "uses"]).to_batches(max_chunksize=50_000)

        for batch in batches:
            for _, texts in _slices(batch):
                words = pre.words(texts).flatten().value_counts()
                keys, long, of = pre.parts(words.field("values"))
                held.append(pa.table({"key": keys, "long": long, "uses": words.field("counts").take(pa.array(of))}))
                rows += len(of)
                if rows > GATHERED:
                    yield from handed_on()
                    held, rows = [], 0
        if held:
            yield from handed_on()

    return run


def _counted(model):
    schema = pa.schema([("key", pa.string()), ("uses", pa.int64()), ("pieces", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PreTokens(model.value).pieces
        for batch in batches:
            full = [long or key for key, long in zip(batch.column("key").to_pylist(), batch.column("long").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("uses"), pa.array(pieces(full), pa.int64())],
                                             schema=schema)

    return run


def _summed(model, heavy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        pre, heavy_keys, heavy_pieces = PreTokens(model.value), *heavy.value
        for batch in batches:
            for at, texts in _slices(batch):
                lists = pre.words(texts)
                doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
                words = lists.flatten().dictionary_encode()
                word = words.indices.to_numpy()
                keys, _, of = pre.parts(words.dictionary)
                known = pc.index_in(keys, heavy_keys)
                is_rare = known.is_null().to_numpy(zero_copy_only=False)
                # The heavy pre-tokens of each distinct word, then of each document.
                of_word = np.zeros(len(words.dictionary), np.int64)
                np.add.at(of_word, of[~is_rare], heavy_pieces[known.drop_null().to_numpy()])
                sums = np.zeros(len(texts), np.int64)
                np.add.at(sums, doc, of_word[word])
                # The rare ones: (document, word) frequencies, then a row for each pre-token of the word.
                has_rare = np.zeros(len(of_word), bool)
                has_rare[of[is_rare]] = True
                mine = has_rare[word]
                pair, uses = np.unique(doc[mine] * len(of_word) + word[mine], return_counts=True)
                order = np.argsort(of[is_rare], kind="stable")
                rare, rare_of = np.flatnonzero(is_rare)[order], of[is_rare][order]
                first, last = (np.searchsorted(rare_of, pair % max(1, len(of_word)), side) for side in ("left", "right"))
                many = last - first
                place = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
                ends = np.searchsorted(np.repeat(pair // max(1, len(of_word)), many), np.arange(len(texts) + 1))
                rest = pa.StructArray.from_arrays([keys.take(pa.array(rare[place])), pa.array(np.repeat(uses, many), pa.int64())], ["key", "uses"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array((len(t.encode()) for t in texts), pa.int64()),
                     pa.array(sums), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)], names=["doc_id", "n_bytes", "summed", "rest"])

    return run


def count_tokens(docs: DataFrame, model_file: str, limit: int = LIMIT) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    n_tokens is the number of ids that the model's library gives for the whole
    text, without begin and end marks. Null and empty texts have no bytes and no
    tokens. Rows are counted each, repeated ones and those with a null doc_id
    too; other columns are ignored; no rows give no rows. Texts may be of any
    length, and so may their pre-tokens (a run of one letter is one). Models
    without byte pieces, or with pieces that run over a space, are refused.
    """
    spark = docs.sparkSession
    with open(model_file, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())  # a vocabulary file, not data
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    uses = (texts.select("text").mapInArrow(_uses(model), "key string, long string, uses long")
            .groupBy("key", "long").agg(F.sum("uses").alias("uses")))
    counts = staged(uses.mapInArrow(_counted(model), "key string, uses long, pieces long"), "pre_tokens")

    # The least bound on uses that HEAVY pre-tokens at most reach, by eighths of a power of two.
    eighth = F.floor(F.log2("uses") * 8)
    heavy_from, reached = None, 0
    for r in counts.groupBy(eighth.alias("e")).agg(F.count("*").alias("n")).orderBy(F.desc("e")).collect():  # some 500 rows at most
        reached += r["n"]
        if reached > HEAVY:
            break
        heavy_from = r["e"]
    is_heavy = eighth >= F.lit(heavy_from) if heavy_from is not None else F.lit(False)
    most_used = counts.where(is_heavy).select("key", "pieces").toArrow()
    heavy = spark.sparkContext.broadcast((most_used["key"].combine_chunks(), most_used["pieces"].to_numpy()))
    doc_type = texts.schema["doc_id"].dataType.simpleString()
    held = staged(texts.mapInArrow(_summed(model, heavy),
                                   f"doc_id {doc_type}, n_bytes long, summed long, rest array<struct<key:string,uses:long>>")
                  .withColumn("row", F.monotonically_increasing_id()), "summed")
    rare = (held.select("row", F.inline("rest")).join(counts.where(~is_heavy).select("key", "pieces"), "key")
            .groupBy("row").agg(F.sum(F.col("uses") * F.col("pieces")).alias("more")))
    n_tokens = F.col("summed") + F.coalesce("more", F.lit(0))
    return (held.select("row", "doc_id", "n_bytes", "summed").join(rare, "row", "left")
            .select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit")))


def op11_token_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
