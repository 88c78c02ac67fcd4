"""The thin ``opN_<name>`` queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, fingerprints, jaccard_join, license_scan, packing, quality_crf, quality_rules, secret_scan,
               sentencepieces, substring_dedup, suffix_dedup, topk_search, whitening)
from .common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_documents(table(spark, sf_dir, "documents"), PIECE_BPE)


def op4_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).drop("text_key")


def op5_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(table(spark, sf_dir, "documents"))


def op6_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op7_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_fingerprints(table(spark, sf_dir, "documents"))


def op8_suffix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op9_pack_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op10_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.drop("text_key").withColumns(
        {c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's deviation is a decimal; here a long, null where 64 bits do not hold it."""
    return (whitening.whiten(table(spark, sf_dir, "embeddings"))
            .withColumn("deviation", F.col("deviation").try_cast("long")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_topk_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_crf": op1_line_crf,
    "op2_substring_doubling": op2_substring_doubling,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_jaccard_tiles": op4_jaccard_tiles,
    "op5_secret_ledger": op5_secret_ledger,
    "op6_license_notices": op6_license_notices,
    "op7_edit_embedding": op7_edit_embedding,
    "op8_suffix_intervals": op8_suffix_intervals,
    "op9_pack_binary": op9_pack_binary,
    "op10_quality_divergence": op10_quality_divergence,
    "op11_whitening": op11_whitening,
    "op12_collocations": op12_collocations,
    "op13_topk_threshold": op13_topk_threshold,
}
