"""Training-data pipeline: quality rules, near and exact dedup, secret masking, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import near_dedup, packing, quality, secrets, substrings
from corpusloom.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the likelihood ratio keep, whole."""
    return quality.judge(docs, table(spark, sf_dir, "labels"), keep_columns=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near duplicates."""
    return near_dedup.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less every byte of a passage that also starts elsewhere."""
    return substrings.remove(docs)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets and widely copied examples of secrets masked."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secret_masking", secret_masking),
    ("best_fit_packing", best_fit_packing),
]

#: Hash tables, sketches and a tokenizer are beyond SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
