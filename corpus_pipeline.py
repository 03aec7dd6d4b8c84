"""A training-text pipeline over ``documents``: five stages, each one operator of siltstone.llm.

Each stage takes the documents that the one before it kept, written and read again, and drops what its
operator rejects; the last one turns texts into token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import bpe, decontamination, exact_dedup, ngram_join, toxicity
from siltstone.llm.registry import table, tokenizer_path
from siltstone.scratch import materialize


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, scores below 0.5."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_copies(docs, keep="largest")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by a Jaccard similarity of 0.8 the smallest id."""
    return ngram_join.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token ``ids`` and their count and digests, and the digest of the decoded bytes."""
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    return bpe.decode(bpe.encode(docs, path), path).select(
        "doc_id", "ids", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_exact_copies),
    ("ngram_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("byte_bpe", as_tokens),
]

#: SQL can't express the trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
