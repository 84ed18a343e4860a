"""Delimited, Parquet and JSON readers with declared schemas (no inference)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide import schema
from roomtide.functions.columns import null_texts_to_null, to_integer
from roomtide.sources.hashes import file_list, reading, scattered

DRIFT_RESULT_KEYS = ["week", "retrain", "reasons"]


CORRUPT = schema.CORRUPT
# Ordinary quoting: a quote inside a quoted field is doubled.
CSV_QUOTING = {"quote": '"', "escape": '"'}


def csv_columns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names from the header only."""
    return spark.read.options(**CSV_QUOTING).option("header", True).csv(path).columns


HEADER_BLOCK = 64 << 10


def first_line(file, row: dict) -> dict:
    """The header of an open file: its bytes up to the first line break, in blocks."""
    parts = []
    while block := file.read(HEADER_BLOCK):
        ends = [at for at in (block.find(b"\n"), block.find(b"\r")) if at >= 0]
        parts.append(block[: min(ends)] if ends else block)
        if ends:
            break
    return {"file_path": row["path"], "header": b"".join(parts).decode("utf-8", "replace")}


def csv_headers(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """The files of ``path`` by header: (column names, files), most files first.

    A task opens each file of the listing and reads its first line, so the data are not scanned; what
    comes back is a row per file, as in Spark's own file listing. The files must be in a store that
    Arrow can open; empty files are in no listing.
    """
    first = scattered(file_list(spark, path)).mapInArrow(reading(first_line, stream=True), "file_path string, header string")
    files: dict[str, list[str]] = {}
    for row in first.select("header", "file_path").orderBy("file_path").toLocalIterator():
        files.setdefault(row.header, []).append(row.file_path)
    groups = sorted(files.values(), key=len, reverse=True)
    return [(csv_columns(spark, group[0]), group) for group in groups]


def read_csv_text(spark: SparkSession, path: str, corrupt: str | None = None, multi_line: bool = False) -> DataFrame:
    """Every column as text, by the name in its own file's header, with the usual "no value" texts turned into null.

    Files may order their columns differently; a column that a file lacks is null in its rows.
    ``corrupt`` names a column that keeps the whole line of a record with too few or too many
    fields, and is null elsewhere. Line breaks inside quotes need ``multi_line``.
    """
    found = csv_headers(spark, path)
    order = found[0][0] if found else csv_columns(spark, path)
    parts = []
    for names, files in found or [(order, path)]:
        order += [n for n in names if n not in order]
        declared = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *([corrupt] if corrupt else [])]])
        reader = spark.read.schema(declared).options(**CSV_QUOTING).option("header", True).option("enforceSchema", False)
        reader = reader.option("mode", "PERMISSIVE").option("multiLine", multi_line)
        if corrupt:
            # fields are counted only where whole lines are parsed
            reader = reader.option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False)
        parts.append(reader.csv(files if len(found) > 1 else path))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    columns = [null_texts_to_null(F.col(f"`{n}`")).alias(n) for n in order]
    return rows.select(*columns, *([corrupt] if corrupt else []))


def typed(df: DataFrame, declared: T.StructType = schema.CLEAN_SCHEMA, strict: bool = False) -> DataFrame:
    """Give text columns their declared types; columns that are not declared stay as they are.

    The lenient form turns a value that does not parse into null, the strict form raises.
    """
    types = {field.name: field.dataType for field in declared.fields}
    out = []
    for name in df.columns:
        source = F.col(f"`{name}`")
        target = types.get(name)
        if target is None:
            out.append(source.alias(name))
        elif strict:
            whole = isinstance(target, T.IntegerType)
            value = source.cast("decimal(20,4)").cast("int") if whole else source.cast(target)
            out.append(value.alias(name))
        elif isinstance(target, T.IntegerType):
            out.append(to_integer(source).alias(name))
        else:
            out.append(source.try_cast(target).alias(name))
    return df.select(out)


def read_bookings_csv(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Bookings file with types by column name, raw or cleaned."""
    return typed(read_csv_text(spark, path), strict=strict)


def read_csv_with_dates(
    spark: SparkSession, path: str, date_columns: Sequence[str], date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """Text columns, except that ``date_columns`` are parsed and raise when they do not parse."""
    rows = read_csv_text(spark, path)
    return rows.withColumns({c: F.to_date(F.col(c), date_format) for c in date_columns})


def read_drift_results(spark: SparkSession, path: str) -> DataFrame:
    """Weekly drift documents, one per line; raises when one lacks a required key."""
    declared = T.StructType(
        [
            T.StructField("week", T.IntegerType()),
            T.StructField("retrain", T.BooleanType()),
            T.StructField("reasons", T.ArrayType(T.StringType())),
        ]
    )
    rows = spark.read.schema(declared).json(path)
    lacking = F.array_compact(
        F.array(*[F.when(F.col(key).isNull(), F.lit(key)) for key in sorted(DRIFT_RESULT_KEYS)])
    )
    message = F.concat(F.lit("drift result lacks "), F.array_join(lacking, ", "))
    checked = F.when(F.size(lacking) > 0, F.raise_error(message).cast("int")).otherwise(F.col("week"))
    return rows.withColumn("week", checked)
