"""A corpus in, token ids out: language, copies, near copies, benchmark passages, pieces.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and is written as Parquet before the
next one reads it. Null ids are kept by every filter; extra columns of the documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import decontaminate, exact_dedup, language, near_dedup, sentencepiece_codec
from lodestrata.llm.frames import ship, stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model does not reject; it is fitted on a bounded sample of the labelled ones."""
    ship(spark)
    return language.in_known_language(docs, language.train(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id."""
    return near_dedup.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    ship(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its piece ids, and whether they decode to its text again."""
    vocabulary = sentencepiece_codec.load()
    return sentencepiece_codec.encode(docs, vocabulary, check_col="round_trip")


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("sentencepiece", pieces),
]

# Trained models and weighted samples decide, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
