"""A corpus pipeline from raw documents to packed training sequences.

Each stage reads what the one before it wrote. The first four return the columns of ``documents``: the quality classifier drops documents,
exact and near deduplication keep one document of each group, and the secret scan masks what it finds. The
last returns the pieces of all documents left, their token ids with their places in the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkdesk.llm import exact_dedup, jaccard_join, line_crf, packing, secret_scan
from sparkdesk.llm.common import table
from sparkdesk.llm.queries import VOCABULARY
from sparkdesk.session import materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; a model without labels to learn from keeps all."""
    return line_crf.drop_bad(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal normalised texts, that of the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar shingle sets, that of the smallest doc_id."""
    return jaccard_join.drop_near(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars stays what it was."""
    return secret_scan.redact(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, packed."""
    return packing.packed_documents(docs, VOCABULARY)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("secret_scan", secrets),
    ("packing", sequences),
]

#: The classifier, the tokenizer and the similarity join have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
