"""Registered queries of the operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, licenses, line_dedup, packing, periodic_runs, pii, prefix_trie, quality_cnn, quality_rules, sharding,
               simhash, toxicity, warc)
from .common import read_table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=40)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), default_tokenizer(), ranks_file=default_ranks())


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(read_table(spark, sf_dir, "documents"), shingle=3, budget=2)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_digest(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(spark, read_table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_digest(read_table(spark, sf_dir, "documents"))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


QUERIES = {f.__name__: f for f in (op1_pii, op2_sharding, op3_packing, op4_licenses, op5_simhash, op6_quality_rules,
                                   op7_quality_cnn, op8_line_dedup, op9_decontamination, op10_toxicity, op11_prefix_trie,
                                   op12_warc, op13_periodic_runs)}
ORACLE_SQL: dict[str, str] = {"op4_licenses": licenses.oracle_sql(), "op11_prefix_trie": prefix_trie.oracle_sql(),
                              "op12_warc": warc.oracle_sql()}
