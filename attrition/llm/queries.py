"""The registered queries of the corpus operators: one per operator, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attrition.llm import (chat_tree, exact_dedup, license_scan, lm_scoring, mixing, ngram_join, packing, periodic_runs,
                           quality, secret_scan, sharding, simhash, whitening)
from attrition.llm.common import table, written
from attrition.llm.oracle import ORACLE  # noqa: F401  the queries' DuckDB twins


def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.Limits(tokens=1024, segments=8, loss=1016))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_components(table(spark, sf_dir, "documents"), ngram_join.JoinOptions(n=4, percent=85))


def op3_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_report(table(spark, sf_dir, "documents"))


def op4_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return report.drop("rejected_by", "stratum")


def op6_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"  # looks like a template's control strings
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_tree.read_back(written(chat_tree.prefix_tree(conversations), "chat-runs"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"), whitening.WhiteningOptions(components=16))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), simhash.SimHashOptions(n=4, radius=4))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_vector_packing, op2_ngram_jaccard_join, op3_suffix_tree_lm, op4_rendezvous_sharding,
                            op5_quality_rules, op6_chat_prefix_tree, op7_exact_dedup, op8_secret_scan,
                            op9_license_scan, op10_source_mixing, op11_periodic_runs, op12_embedding_whitening,
                            op13_simhash_near_dedup)
}
