"""The corpus pipeline: quality, near-duplicates, benchmark, private data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on
everything its predecessor kept. All but the last return the columns of
``documents``. ``run`` applies them to the documents of ``sf_dir``; between
stages the rows are cut into the shared checkpoint folder, so a lost executor
costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskpulse.llm import decontaminate, minhash_dedup, pii, quality, sentencepiece_scan
from deskpulse.llm.io import cut, small_batches, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the hierarchical quality classifier keeps."""
    small_batches(spark)
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return minhash_dedup.drop_near_duplicates(docs, k=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with private data replaced by its kind; n_chars follows the text."""
    return pii.redact_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of each document, with digests of the decoded text."""
    return sentencepiece_scan.tokenized(docs)


STAGES = [
    ("quality", quality_stage),
    ("minhash_dedup", dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("sentencepiece", token_stage),
]

#: Boosted trees, latent search and merges by rank are not SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else cut(docs), sf_dir)
    return docs
