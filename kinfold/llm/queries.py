"""One query per operator over its whole table, with the parameters of production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import (
    bpe, hard_negatives, line_templates, mixing, near_duplicates, quality_rules, secrets, spelling, token_files, token_groups, url_lists,
    vamana, word_pieces)
from kinfold.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.components(_table(spark, sf_dir, "documents"))


def op2_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.report(_table(spark, sf_dir, "pages"))


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.findings(_table(spark, sf_dir, "documents"), path="doc_id", text="text"))


def op4_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(_table(spark, sf_dir, "documents"))


def op5_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(_table(spark, sf_dir, "documents"))


def op6_perfect_hash_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.report(_table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"))


def op7_word_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_pieces.report(_table(spark, sf_dir, "documents"))


def op8_vamana_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.report(_table(spark, sf_dir, "embeddings"))


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.report(_table(spark, sf_dir, "documents"))


def op10_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def op11_fagin_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.report(_table(spark, sf_dir, "embeddings"))


def op12_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_groups.components(_table(spark, sf_dir, "documents"))


def op13_pivotal_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_postings, op2_temporal_url_lists, op3_secret_ledger, op4_quality_divergence, op5_speculative_bpe,
    op6_perfect_hash_files, op7_word_piece_counts, op8_vamana_shards, op9_line_templates, op10_entropy_mix,
    op11_fagin_negatives, op12_token_group_join, op13_pivotal_spellings)}
