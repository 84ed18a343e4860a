"""Pieces shared by the operators of this folder: word hashing, files, scratch tables, components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide.session import cut_lineage, shared_path

# The white space of every contract, and an odd multiplier with its inverse modulo 2^64.
WHITE_BYTES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def worker_store() -> types.ModuleType:
    """A place that lives as long as the Python worker, for caches that several tasks share."""
    return sys.modules.setdefault("_roomtide_worker", types.ModuleType("_roomtide_worker"))


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | list | None], schema: T.StructType | str) -> DataFrame:
    """``work`` on every Arrow batch; it returns a dict of columns, or None for nothing."""
    from pyspark.sql.pandas.types import to_arrow_schema

    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(declared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch)
            if made is not None:
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, type=f.type, from_pandas=False) for c, f in zip(made, arrow)], schema=arrow
                )

    return df.mapInArrow(run, declared)


def fast_list(column: pa.Array) -> list:
    """The values of a column of texts, or of numbers without nulls; many times faster than a scalar each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i <= n, kept by the worker."""
    store = worker_store()
    have = getattr(store, "powers", None)
    if have is None or len(have[0]) <= n:
        size = max(1 << 16, 1 << int(n + 1).bit_length())
        up = np.full(size, BASE, np.uint64)
        down = np.full(size, BASE_INVERSE, np.uint64)
        up[0] = down[0] = 1
        have = store.powers = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of an unsigned 64-bit array over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_spans(data: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that ``apart`` (256 flags) does not mark."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~apart[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of all words of a text at once, equal for equal bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=running[1:])
    return mix((running[ends] - running[starts]) * down[starts])


def parity(own: np.ndarray) -> bytes:
    """Which slots of the hash an odd number of the different values ``own`` falls into, as bits; at least two slots a value."""
    slots = 1 << max(9, int(2 * len(own)).bit_length())
    odd = np.bincount((own & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(left: bytes, right: bytes) -> int:
    """A number of values that two sets cannot share at least, from their parities: each of them turns one bit."""
    one, two = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    while len(one) > len(two):  # half as many slots
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    while len(two) > len(one):
        two = two[: len(two) // 2] ^ two[len(two) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


def white() -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(WHITE_BYTES)] = True
    return flags


def open_folder(path: str):
    """A pyarrow file system and the path on it; local paths and URIs of shared stores."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def shared(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of the shared folder, so that it is computed once and survives lost executors."""
    return cut_lineage(df, label)


def new_folder(spark, label: str) -> str:
    return shared_path(spark, label)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label), label the smallest node reachable, for every node of an edge but the smallest ones themselves.

    Alternating large and small stars: every round joins edges with one minimum per node,
    written to the shared folder. Nodes may be of any ordered type; null ends are ignored.
    """
    rows = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    rows = shared(rows.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v"))).repartition("u")
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.where("u > v").repartition("u")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        rows = shared(low.select("u", F.col("m").alias("v")).unionByName(hung).distinct(), "edges")
        # Settled when each node hangs on one parent that hangs on none, and nothing moved.
        now = rows.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return rows.select(F.col("u").alias("node"), F.col("v").alias("label"))
