"""From documents to training sequences: classify, apply rules, remove near-duplicates and
repeated passages, pack.

Each stage works on all rows that the one before kept and returns the columns of
``documents``, the last one the pieces and their places in sequences. Each result is written
to the shared folder as Parquet and reread, so a lost executor costs one stage's tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantline.checkpoints import written
from grantline.llm import (
    compression_quality,
    near_dedup,
    packing,
    substring_dedup,
    target_ratio,
)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier predicts to be good."""
    return compression_quality.keep(docs, compression_quality.fit(docs, _labels(spark, sf_dir)))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the ratio to the trusted target."""
    table = target_ratio.ratios(docs, _labels(spark, sf_dir))
    return target_ratio.judged(docs, table).where("kept").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates. Of rows
    with one id, or none, and the same text one is left."""
    found = near_dedup.near_duplicates(docs)
    dropped = found.where("NOT kept").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti")
    digest = kept.withColumn("digest_", F.sha2("text", 256))
    return digest.dropDuplicates(["doc_id", "digest_"]).select(docs.columns)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one holds; others stay as they are."""
    found = substring_dedup.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = found.withColumn("text", text)
    return changed.withColumn(
        "n_chars",
        F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"),
    ).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and offset."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(docs, path))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_passages),
    ("packing", pack),
]

#: SQL can express neither the compression classifier nor the genetic packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
