"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Terms of a text are its byte trigrams (over the whole text, hashed to a fixed
width) and a few bucketed shape terms; weights are square roots of relative
counts. A truncated SVD of a bounded sample of labelled rows gives the latent
space; the labelled vectors (at most ``MAX_LABELLED x RANK`` doubles, about 2 MB)
are broadcast, and every document's score is the similarity-weighted label of
its nearest neighbours, from exact cosine products in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import table

WIDTH = 2048          # hashed byte trigrams
SHAPES = 72           # bucketed shape terms behind them
RANK = 64
NEIGHBOURS = 15
SHARPNESS = 8         # weight of a neighbour = max(cosine, 0) ** SHARPNESS
#: Bound on the labelled rows used to fit (those with the smallest hash of their id).
MAX_LABELLED = 4000
#: Text bytes handled at once; a document's counts are sums over its blocks.
BLOCK_BYTES = 1 << 20


def _grams(data: bytes) -> np.ndarray:
    counts = np.zeros(WIDTH)
    for a in range(0, max(len(data) - 2, 0), BLOCK_BYTES):
        b = np.frombuffer(data[a:a + BLOCK_BYTES + 2], np.uint8).astype(np.uint32)
        h = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        h *= np.uint32(0x9E3779B1)
        h >>= np.uint32(21)
        counts += np.bincount(h, minlength=WIDTH)
    return counts


def _shape(text: str) -> list[int]:
    """Indices of the bucketed shape terms (below SHAPES): nine families of eight buckets."""
    ws = text.split()
    n = max(len(ws), 1)
    chars = max(len(text), 1)
    letters = sum(map(len, ws)) or 1
    lines = [x for x in text.split("\n") if x.strip()]
    upper = sum(map(str.isupper, ws))
    marked = sum(text.count(c) for c in "#*$%&|<>!{}")
    digits = sum(text.count(c) for c in "0123456789")
    share = [
        len(set(ws)) / n, 1 - len(set(lines)) / max(len(lines), 1), upper / n, 4 * marked / letters,
        4 * digits / letters, letters / n / 16, sum(x.endswith((".", "!", "?")) for x in ws) * 4 / n,
        min(np.log2(chars) / 20, 1), 2 * (sum(map(eq, ws, ws[1:])) + sum(map(eq, ws, ws[2:]))) / n,
    ]
    return [8 * k + min(int(8 * s), 7) for k, s in enumerate(share)]


def terms(text: str | None) -> np.ndarray:
    """Unit-length term vector of one whole text (zeros for an empty one)."""
    text = text or ""
    v = np.zeros(WIDTH + SHAPES)
    if not text.strip():
        return v
    g = _grams(text.encode("utf-8", "surrogatepass"))
    v[:WIDTH] = np.sqrt(g / max(g.sum(), 1.0))
    for k in _shape(text):
        v[WIDTH + k] = 0.35
    return v / np.linalg.norm(v)


@dataclass(frozen=True)
class Voter:
    """The fitted model: projection, unit vectors of the labelled rows, their labels and the fallback share."""
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def scores(self, texts) -> np.ndarray:
        x = np.stack([terms(t) for t in texts]) @ self.projection
        norm = np.linalg.norm(x, axis=1)
        x /= np.where(norm > 0, norm, 1.0)[:, None]
        cos = x @ self.vectors.T
        k = min(NEIGHBOURS, cos.shape[1])
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cos, near, axis=1), 0, None) ** SHARPNESS
        total = weight.sum(axis=1)
        voted = (weight * self.labels[near]).sum(axis=1)
        score = np.where(total > 0, voted / np.where(total > 0, total, 1.0), self.prior)
        return np.where(norm > 0, np.clip(score, 0.0, 1.0), 0.0)


def held_out() -> F.col:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Voter | None:
    """Fit on at most MAX_LABELLED labelled rows that are not held out; None without any usable row."""
    usable = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out())
              .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    vectors = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
               .mapInPandas(_term_rows, "doc_id long, quality int, v binary"))
    # The sample is bounded, so one task holds it; the driver gets the space and the labelled vectors in it, about 3 MB.
    rows = vectors.repartition(1).mapInPandas(_latent, "kind string, quality int, z binary").collect()
    if not rows:
        return None
    basis = np.stack([np.frombuffer(r["z"]) for r in rows if r["kind"] == "basis"])
    labelled = [r for r in rows if r["kind"] == "row"]
    y = np.array([r["quality"] for r in labelled], float)
    return Voter(basis, np.stack([np.frombuffer(r["z"]) for r in labelled]), y, float(y.mean()))


def _latent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The truncated SVD of the sample: rows of the projection (kind 'basis') and the labelled unit vectors (kind 'row')."""
    parts = [df[df["v"].map(any).astype(bool)] for df in batches]
    if not sum(map(len, parts)):
        return
    df = pd.concat(parts).sort_values(["doc_id", "v"], ignore_index=True)
    x = np.stack([np.frombuffer(v, np.float32) for v in df["v"]]).astype(np.float64)
    values, basis = np.linalg.eigh(x.T @ x)
    basis = np.ascontiguousarray(basis[:, np.argsort(-values)[:RANK]])
    z = x @ basis
    z /= np.maximum(np.linalg.norm(z, axis=1), 1e-12)[:, None]
    yield pd.DataFrame({"kind": "basis", "quality": 0, "z": [b.tobytes() for b in basis]})
    yield pd.DataFrame({"kind": "row", "quality": df["quality"], "z": [v.tobytes() for v in z]})


def _term_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        yield pd.DataFrame({"doc_id": df["doc_id"], "quality": df["quality"].astype("int32"),
                            "v": [terms(t).astype(np.float32).tobytes() for t in df["text"]]})


def score(docs: DataFrame, model: Voter | None) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> doc_id, held_out, score, predicted for every input row.

    Empty, blank and null texts score 0. Repeated rows and equal texts get
    equal scores; ties at 0.5 predict 1. Without a model (no usable label)
    every row scores 0.5. Other columns are never read; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voter = shared.value
        for df in batches:
            for a in range(0, len(df), 256):
                part = df.iloc[a:a + 256]
                s = voter.scores(part["text"]) if voter else np.full(len(part), 0.5)
                yield pd.DataFrame({"doc_id": part["doc_id"], "held_out": part["held_out"], "score": s,
                                    "predicted": (s >= 0.5).astype("int32")})

    rows = docs.select(F.col("doc_id").cast("string"), held_out().alias("held_out"), F.col("text").cast("string"))
    return (rows.mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int")
            .withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)))


def op8_nearest_neighbour_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
