"""Corpus pipeline: from the documents table to token ids of clean, distinct, uncontaminated texts.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written as
Parquet and read again. All but the last return the columns of documents.

Null and empty texts have no words: the classifier judges them by their structure, no stage links
them or finds anything in them. Rows without id pass every stage as documents of their own. Of rows
with one id the near-duplicate stage keeps one. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from souklake.llm import bpe, decontaminate, minhash, quality_model, secrets
from souklake.llm.components import stored
from souklake.llm.queries import VOCABULARY, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the classifier scores 0.7 or more."""
    machine = quality_model.fit(docs, table(spark, sf_dir, "labels"), usable=quality_model.fold() != 2)
    return quality_model.accepted(docs, machine)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group linked by a similarity of 0.8 or more."""
    return minhash.without_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with at least one word in twenty inside benchmark windows."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the text by a mark; n_chars follows."""
    return secrets.redacted(docs, length_column="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): little-endian unsigned 32-bit ids."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("tokens", tokens),
]

#: SQL cannot express the classifier; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
