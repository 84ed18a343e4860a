"""File checksums and order-free table fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class ChecksumMismatch(ValueError):
    """A source file is not the one that was expected."""


WHOLE_BYTES = 64 << 20  # files up to this size are hashed by Spark's own functions
BLOCK_BYTES = 8 << 20
SCATTER = 10_000  # most tasks for one listing


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """path and length of every file; no content is read. Spark leaves empty files out of a listing."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def reading(blocks: Callable, stream: bool = False) -> Callable:
    """A task function that opens the files of its rows one after another; ``blocks`` makes rows from (file, row).

    As a stream a compressed file is read decompressed, by its name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                path = row["path"]
                if path.startswith("file:"):
                    system, inner = fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
                else:
                    system, inner = fs.FileSystem.from_uri(path)
                with system.open_input_stream(inner) if stream else system.open_input_file(inner) as file:
                    yield pa.RecordBatch.from_pylist([blocks(file, row)])

    return run


def scattered(rows: DataFrame) -> DataFrame:
    """A task for about every row, whatever the rows weigh: a listing is tiny, what it names is not."""
    return rows.repartition(max(1, min(SCATTER, rows.count())))


def streamed_checksums(files: DataFrame) -> DataFrame:
    """path, bytes and SHA-256 of listed files of any size; a task holds one block of one file.

    A SHA-256 runs from the first byte to the last, so one task reads a file; see :func:`block_digests`
    for the parallel form. The files must be in a store that Arrow can open.
    """
    size = BLOCK_BYTES

    def digest(file, row: dict) -> dict:
        found = hashlib.sha256()
        while block := file.read(size):
            found.update(block)
        return {"path": row["path"], "bytes": row["length"], "sha256": found.hexdigest()}

    return scattered(files).mapInArrow(reading(digest), "path string, bytes bigint, sha256 string")


def file_checksums(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """path, bytes and SHA-256 of every file under ``path``, of any size but empty (see :func:`file_list`)."""
    small = spark.read.format("binaryFile").load(path).where(F.col("length") <= whole_bytes)
    found = small.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = file_list(spark, path).where(F.col("length") > whole_bytes)
    return found.unionByName(streamed_checksums(large)) if large.limit(1).count() else found


def block_digests(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """path, block, start, bytes and SHA-256 of every block of every file: all blocks are read in parallel.

    Two such tables compared show which blocks of a huge file differ.
    """
    last = F.floor((F.col("length") - 1) / block_bytes)
    blocks = file_list(spark, path).where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    blocks = blocks.select("path", "block", (F.col("block") * block_bytes).alias("start"), "length")

    def digest(file, row: dict) -> dict:
        file.seek(row["start"])
        data = file.read(min(block_bytes, row["length"] - row["start"]))
        return {"path": row["path"], "block": row["block"], "start": row["start"], "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()}

    return scattered(blocks).mapInArrow(reading(digest), "path string, block bigint, start bigint, bytes bigint, sha256 string")


def verify_checksum(spark: SparkSession, path: str, expected: str) -> str:
    """The file's SHA-256; raises when it differs from ``expected`` (upper or lower case)."""
    found = file_checksums(spark, path).select("sha256").first()
    if found is None:
        raise FileNotFoundError(path)
    if found.sha256.lower() != expected.strip().lower():
        raise ChecksumMismatch(f"{path}: expected {expected}, found {found.sha256}")
    return found.sha256


def md5_number(*columns: str | Column) -> Column:
    """The first 15 hex digits of the md5 of the columns as text, joined by a bar: a number any engine can make."""
    text = F.concat_ws("|", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def fingerprint_columns(columns: Sequence[str], portable: bool = False) -> list[Column]:
    """Aggregates that change with any row, but not with row order or partitioning."""
    row = md5_number(*columns) if portable else F.xxhash64(*columns)
    return [
        F.count("*").alias("n_rows"),
        F.sum(row.cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(row).alias("hash_xor"),
    ]


def fingerprint(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), portable: bool = False
) -> DataFrame:
    """Order-free fingerprint of a table, or of every group of it. The portable form can be made again elsewhere."""
    columns = list(columns or [c for c in df.columns if c not in by])
    return df.groupBy(*by).agg(*fingerprint_columns(columns, portable))
