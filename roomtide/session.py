"""Session helpers: the shared folder and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "roomtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and a UTC clock; cluster settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # recording the call site of every column expression makes building large plans slow
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return named


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy survives the loss of any executor, and two readers of it see the same rows.
    """
    path = shared_path(df.sparkSession, label)
    if partition_by:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
