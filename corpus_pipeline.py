"""Corpus pipeline: quality, exact copies, near copies, benchmark passages, tokens.

Every stage takes the documents that its predecessor kept, as a table; all but the last return
them with the columns of ``documents``. Each stage's decision is final: its rows are written and read
again before the next stage begins, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewake.llm import byte_bpe, decontaminate, exact_dedup, jaccard_join, quality
from tradewake.llm.frames import table, vocabulary_path
from tradewake.session import stored


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones of them."""
    return quality.keep_good(docs, table(spark, folder, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group that is equal but for white space: the longest, then the first."""
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document, the one with the smallest id, of every group linked by sets of five-word
    shingles with a Jaccard similarity of 0.8 or more."""
    return jaccard_join.drop_near_copies(docs, size=5, num=4, den=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    return decontaminate.drop_contaminated(docs, table(spark, folder, "benchmark"))


def token_digests(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Number and digest of every document's tokens, and of the text that they decode to."""
    return byte_bpe.encode_decode(docs, vocabulary_path(), full=False)


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe_coding", token_digests),
]

# Neither the learned classifier nor byte-pair merging can be stated in SQL;
# tests/llm/test_pipeline.py compares the stages with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
