"""A training-corpus pipeline: STAGES applied in order to ``documents``.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the
last returns packed pieces.  Every stage is an operator of ``lodgeflow.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm import jaccard_join, packing, quality_rules, queries, secret_scan, suffix_dedup
from lodgeflow.llm.common import table, written


def recounted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, by the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the divergence rules reject go."""
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return jaccard_join.one_of_each(docs)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that stand earlier go from the texts; no document goes."""
    return recounted(suffix_dedup.without_repeats(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are redacted in the texts."""
    return recounted(secret_scan.without_secrets(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document that is left."""
    return packing.pack(docs, queries.WORD_BPE)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_bytes),
    ("secret scans", secrets),
    ("packing", packed),
]

#: Components, byte spans and tokenizers have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
