"""The stages of the corpus pipeline, each one operator applied to all that is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.llm import near_groups, packing, quality, spaced_seeds


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality; rows with one id share a verdict."""
    scored = quality.score_quality(docs, read(spark, sf_dir, "labels"))
    rejected = scored.groupBy("doc_id").agg(F.max("predicted").alias("best")).where("best = 0")
    rejected = rejected.select(F.col("doc_id").alias("__rejected"))
    return docs.join(rejected, F.col("doc_id").eqNullSafe(F.col("__rejected")), "left_anti")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of the SimHash operator, and of texts whose shingle sets are alike beyond it."""
    return near_groups.keep_one(docs, fingerprints=True)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = spaced_seeds.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    leaking = leaks.select(F.col("doc_id").alias("__leaking")).distinct()
    return docs.join(leaking, F.col("doc_id").eqNullSafe(F.col("__leaking")), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)
