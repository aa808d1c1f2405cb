"""A corpus pipeline: quality rules, exact copies, near copies, the mix of sources, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vedrina.llm.exact_dedup import distinct_documents
from vedrina.llm.mixing import mixture
from vedrina.llm.quality import good_documents
from vedrina.llm.sentencepiece import encode
from vedrina.llm.simhash import without_near_duplicates
from vedrina.shared import new_path, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return distinct_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixture(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with token ids in place of their texts."""
    return encode(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources", mixing),
    ("SentencePiece encoding", sentencepiece_encoding),
]

# Fingerprints and pieces are beyond SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), new_path(spark, f"pipeline-{number}"))
    return docs
