"""Corpus pipeline: quality rules, exact duplicates, near duplicates, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from attrition.llm import exact_dedup, mixing, ngram_join, packing, quality  # noqa: E402
from attrition.llm.common import drop_written, table, written  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base checks or a certified cutoff reject go."""
    drop_written(spark, docs)
    return quality.keep_rows(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest id."""
    drop_written(spark, docs)
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share 0.8 of their five-word shingles stays."""
    drop_written(spark, docs)
    return ngram_join.keep_one(docs, ngram_join.JoinOptions(n=5, percent=80))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights, as documents; a document taken twice is there twice."""
    drop_written(spark, docs)
    return mixing.mixed_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes in the packed sequences."""
    drop_written(spark, docs)
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("exact_duplicates", exact_duplicates), ("near_duplicates", near_duplicates),
          ("source_mixing", source_mixing), ("sequence_packing", sequence_packing)]

#: The tokenizer and the seeded draws have no SQL form; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each read from what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
