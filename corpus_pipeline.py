"""From raw documents to packed batches: quality, near-duplicates, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomtide.llm import stages
from roomtide.llm.common import shared

STAGES = [
    ("quality", stages.keep_quality),
    ("near_duplicates", stages.keep_one_of_each_group),
    ("decontamination", stages.drop_leaks),
    ("packing", stages.pack),
]

# The classifier is fitted by descent, which SQL cannot express; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
