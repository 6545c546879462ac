"""The corpus pipeline: five stages from raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewise.llm import decontaminate, lines, packing, quality, simhash
from dosewise.llm.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.select(docs, quality.train(docs, labels))


def without_copied_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).drop("text_h")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_copied_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

# Trained weights, fingerprints and packing have no SQL; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that the stage before it kept, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
