"""Table and document sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from roomtide.sources.readers import CSV_QUOTING


def write_table(df: DataFrame, path: str, file_format: str = "parquet") -> str:
    """Overwrite ``path`` with ``df`` as Parquet, or as CSV with a header on request."""
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.options(**CSV_QUOTING).option("header", True)
    writer.format(file_format).save(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], sort_by: Sequence[str] = ()) -> str:
    """One folder per value of ``by``; folders of an earlier run are removed.

    Rows are brought together by ``by`` with adaptive rebalancing: a value with a third of
    the table is written by many tasks, and rare values do not leave a file per task.
    ``sort_by`` orders rows within each file for tighter min/max statistics.
    """
    df = df.hint("rebalance", *by)
    if sort_by:
        df = df.sortWithinPartitions(*by, *sort_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*by).parquet(path)
    return path


def write_documents(df: DataFrame, path: str) -> str:
    """One JSON document per row; nested structs and arrays are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path

