"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, BPE ids.

Every stage gets the documents that the stage before kept, as a written table.
All but the last return the columns of `documents`; `n_chars` follows the text.
Stages on the whole corpus (references, templates, components, mixture) have no
row-by-row SQL, so ORACLE_SQL is None and the tests replay them by brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinfold.llm import bpe, line_templates, mixing, near_duplicates, quality_rules
from kinfold.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.judge(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; those that lost lines and keep none with a word go."""
    cut = line_templates.dedup(docs, out="line_counts")
    left = cut.filter((F.col("line_counts.n_dropped") == 0) | F.col("text").rlike(line_templates.WORDED)).drop("line_counts")
    return left.withColumn("n_chars", F.char_length("text").cast("long"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of its source takes it."""
    return mixing.mixture(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the hash of what they decode to."""
    coded = docs.select("doc_id", "lang", "source", bpe.encode_and_decode(F.col("text")).alias("coded"))
    return coded.select("doc_id", "lang", "source", bpe.n_ids(F.col("coded.ids")).alias("n_tokens"), F.col("coded.ids").alias("ids"),
                        F.sha2("coded.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("mixing sources", mixing_stage),
    ("BPE ids", bpe_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
