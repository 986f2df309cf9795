"""Corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet below the shared checkpoint folder and reads again as the
next stage's documents.  All stages but the last return the columns of
documents; the last returns each document with its token ids.

The first stage learns from labels, so SQL cannot express the rows of ``run``;
the tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wxgrid.llm import bpe, decontaminate, jaccard_join, line_dedup, toxicity
from wxgrid.llm.common import table, written
from wxgrid.llm.queries import tokenizer_path

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator accepts."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a larger id repeats."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    return jaccard_join.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that benchmark phrases cover."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids, with the checksums of ids and decoded text."""
    return bpe.encode(docs, tokenizer_path(), ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("near duplicates", one_of_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
