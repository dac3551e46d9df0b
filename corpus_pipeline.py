"""Training-data pipeline over ``documents``: a list of stages, each written as Parquet and reread by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. Rows with a null
doc_id have no identity to keep: quality rules drop them with the rejects.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm import knn_quality, packing
from vigilo.llm.common import staged, table
from vigilo.llm.minhash import near_duplicates
from vigilo.llm.quality_rules import quality_rules
from vigilo.llm.secret_scan import redact


def _text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(docs["text"].cast("string"))


def _only(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows whose own id and text (by its hash) have a row in ``verdicts(doc_id, text_hash)``."""
    keys = verdicts.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    return docs.join(keys, (docs["doc_id"] == F.col("_id")) & (_text_hash(docs) == F.col("_hash")), "left_semi").select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go (texts of the others stay as they are)."""
    return _only(docs, quality_rules(docs).where("kept"))


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of low quality go; the model is fitted on the labelled rows of the whole table."""
    model = knn_quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    own = F.concat_ws(":", docs["doc_id"].cast("string"), _text_hash(docs).cast("string"))  # the verdict is for this id and text
    good = knn_quality.score(docs.select(own.alias("doc_id"), "text"), model).where("predicted = 1").select(F.col("doc_id").alias("_own"))
    return docs.where("doc_id is not null").join(good, own == F.col("_own"), "left_semi").select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest id (rows equal in id and text: one)."""
    return _only(docs, near_duplicates(docs).where("kept")).dropDuplicates(["doc_id", "text"])


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind in brackets; no document goes."""
    return redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of packed sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES = [
    ("quality rules", quality_stage),
    ("quality classifier", classifier_stage),
    ("minhash near-dedup", dedup_stage),
    ("secret scan", secrets_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # the classifier and the tokens have no SQL form; tests compare the stages with brute force
