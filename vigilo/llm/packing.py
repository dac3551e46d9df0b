"""Hierarchical multi-length packing of token ids into power-of-two windows.

Documents are routed by length to context-size tiers. Each tier opens windows
of its size; gaps of long windows are filled from shorter tiers (the longest
piece that fits, and a cut piece for what is left), what remains is chained
into long windows, and the closing tail goes down the ladder of powers of two,
so no window needs padding while the ladder reaches down to one token. The
windows of a group are dealt to step groups of nearly equal token counts.

Groups are bounded runs of rows within one input partition: no shuffle, memory
bounded by the group and the longest text, and a lost task repeats alone.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import table
from vigilo.llm.tokens import ChunkTokenizer

WINDOW = 2048
TIERS = (2048, 1024, 512, 256)
END_ID = 1
#: Tokens gathered before a group is packed.
GROUP_TOKENS = 1 << 20
STEP_GROUPS = 8
TOKENIZER = "word_bpe_49k.json"

SCHEMA = ("doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, tier long, step_group long")


def pack(sizes: list[int], tiers=TIERS) -> list[list[tuple[int, int, int]]]:
    """Pack documents of the given token counts; returns windows as lists of (document, start, length).

    Every token lies in exactly one piece; every window's length is a power of two, at most ``tiers[0]``.
    """
    top, windows = tiers[0], []
    parts: dict[int, list] = {t: [] for t in tiers}
    for doc, n in enumerate(sizes):
        for at in range(0, n - top + 1, top):
            windows.append([(doc, at, top)])
        if n % top:
            left = n % top
            tier = min(t for t in tiers if t >= left)
            parts[tier].append((left, doc, n - left))
    pool: list[tuple[int, int, int]] = sorted(p for t in tiers[1:] for p in parts[t])
    open_windows = []
    for tier in tiers:
        for part in sorted(parts[tier], reverse=True):
            if tier != top:
                k = bisect_right(pool, part) - 1
                if k < 0 or pool[k] != part:
                    continue  # already used to fill a longer window
                pool.pop(k)
            window, gap = [part], tier - part[0]
            while gap and pool:
                k = bisect_right(pool, (gap, float("inf"), 0)) - 1
                if k >= 0:
                    piece = pool.pop(k)
                else:  # nothing fits whole: cut the shortest
                    n, doc, at = pool.pop(0)
                    piece = (gap, doc, at)
                    insort(pool, (n - gap, doc, at + gap))
                window.append(piece)
                gap -= piece[0]
            (windows if not gap else open_windows).append([(d, a, n) for n, d, a in window])
    # The rest is chained and cut into full windows, its tail down the ladder.
    chain = [p for w in open_windows for p in w] + [(d, a, n) for n, d, a in pool]
    total = sum(n for _, _, n in chain)
    goals = [top] * (total // top) + [1 << b for b in range(top.bit_length() - 1, -1, -1) if (total % top) >> b & 1]
    k = at = 0
    for goal in goals:
        window = []
        while goal:
            doc, start, n = chain[k]
            take = min(goal, n - at)
            window.append((doc, start + at, take))
            goal, at = goal - take, at + take
            if at == n:
                k, at = k + 1, 0
        windows.append(window)
    return windows


def _merged(window):
    """Neighbouring pieces of one document that follow each other become one."""
    out = []
    for doc, start, n in window:
        if out and out[-1][0] == doc and out[-1][1] + out[-1][2] == start:
            out[-1] = (doc, out[-1][1], out[-1][2] + n)
        else:
            out.append((doc, start, n))
    return out


def _packed(group: list[tuple], first: int) -> tuple[pd.DataFrame, int]:
    from zlib import crc32

    windows = pack([len(ids) // 4 for _, ids in group])
    windows.sort(key=lambda w: -sum(p[2] for p in w))
    rows = []
    for k, window in enumerate(windows):
        size = sum(p[2] for p in window)
        lap, turn = divmod(k, STEP_GROUPS)
        step = turn if lap % 2 == 0 else STEP_GROUPS - 1 - turn
        offset = 0
        for doc, start, n in _merged(window):
            name, ids = group[doc]
            rows.append((name, start, n, crc32(memoryview(ids)[4 * start:4 * (start + n)]), len(ids) // 4, first + k, offset,
                         size, min((t for t in TIERS if t >= size), default=WINDOW), step))
            offset += n
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]), first + len(windows)


def pack_documents(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per piece of a packed sequence.

    A document's tokens are its text's ids without special tokens, then END_ID;
    null and empty texts are that id alone. Columns: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, tier, step_group.
    Each input row is a document of its own (repeated rows are packed each; a
    null doc_id stays null). Extra columns are ignored; no rows give no rows.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, not data

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = ChunkTokenizer(definition.value)
        end = END_ID.to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 40
        group, held = [], 0
        for df in batches:
            for a in range(0, len(df), 128):
                part = df.iloc[a:a + 128]
                group += zip(part["doc_id"], (x + end for x in tok.ids(part["text"])))
                held += sum(len(x) // 4 for _, x in group[-len(part):])
                if held >= GROUP_TOKENS:
                    out, sequence = _packed(group, sequence)
                    yield out
                    group, held = [], 0
        if group:
            yield _packed(group, sequence)[0]

    out = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInPandas(run, SCHEMA)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op6_hierarchical_packing(spark, sf_dir):
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
