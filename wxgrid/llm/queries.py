"""Queries of the numbered operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (backoff_lm, bpe, collision_ann, decontaminate, jaccard_join, language_id, license_scan, line_dedup, merkle, multi_index,
               suffix_dedup, toxicity, warc)
from .common import table


#: Tokenizer file of the BPE query; any tokenizers file may be given to ``bpe.encode``.
TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.report(table(spark, sf, "documents"), tokenizer_path())


def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_collision_ann(spark: SparkSession, sf: str) -> DataFrame:
    return collision_ann.report(table(spark, sf, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.report(table(spark, sf, "documents"))


def op6_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.report(table(spark, sf, "documents"))


def op7_backoff_lm(spark: SparkSession, sf: str) -> DataFrame:
    return backoff_lm.report(table(spark, sf, "documents"))


def op8_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.report(table(spark, sf, "documents"))


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.report(table(spark, sf, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf, "documents"))


def op11_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.report(table(spark, sf, "pages"))


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return multi_index.report(table(spark, sf, "embeddings"))


def op13_merkle(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.report(table(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_bpe, op3_decontaminate, op4_collision_ann, op5_line_dedup, op6_license_scan,
                               op7_backoff_lm, op8_jaccard_join, op9_language_id, op10_suffix_dedup, op11_warc, op12_hard_negatives, op13_merkle)}
