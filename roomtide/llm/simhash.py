"""SimHash near-duplicates with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 22 bits. Two fingerprints that
differ in at most two bits agree exactly on one segment (three segments, two errors) and
differ in at most two bits on the one after it. Padded to 23 bits, that next segment is
decoded with the perfect binary Golay code, and so are its 23 neighbours at distance one:
words at distance two or less share a neighbour, hence a codeword index. A segment has one
index or six, so a fingerprint has about sixteen keys of some 33 bits. Fingerprints that
share a key with another are candidates.

Candidates are verified without listing pairs: two words differ in at most two bits if and
only if they share a word at distance one or less from both, so every candidate is joined to
the smallest candidate at each of its 65 words. A group of thousands of near copies costs 65
rows a fingerprint, and no link is lost. Connected components follow from these stars.

Cases: a null text counts as empty; a text without words has fingerprint zero and is linked
like any other; null ids take no part in the smallest id; repeated rows each get a row; an
empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide.llm.common import LOWER, components, map_batches, shared, worker_store

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GOLAY = 0xC75  # Fixed value: generator polynomial of the binary Golay code


def shingle_hashes(text: str | None, width: int = 3) -> np.ndarray:
    """XXH64 of every run of ``width`` words, repeats included."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-width] + 1)).tolist()
    parts = map(joined.__getitem__, map(slice, starts, ends[width - 1 :].tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as an unsigned number."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 255 * 256):
        part = hashes[k : k + 255 * 256].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:
            counts += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        counts += bits[whole:].sum(0, dtype=np.uint8)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > len(hashes)).astype(np.uint64)).sum(dtype=np.uint64))


def with_fingerprints(df: DataFrame, text: str, keep: list[str], width: int = 3, name: str = "fp") -> DataFrame:
    """The columns ``keep`` of every row and the fingerprint of its text, as a signed long."""
    source = df.select(*keep, F.col(text).alias("__text"))
    schema = source.drop("__text").schema.add(name, T.LongType())
    n = len(keep)

    def work(batch: pa.RecordBatch):
        prints = np.array([majority(shingle_hashes(t, width)) for t in batch.column(n).to_pylist()], np.uint64).view(np.int64)
        return [*batch.columns[:n], pa.array(prints)]

    return map_batches(source, work, schema)


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and high 11 bits, and the error pattern of each remainder."""

    def remainder(x: int) -> int:
        for k in range(22, 10, -1):
            if x >> k & 1:
                x ^= GOLAY << (k - 11)
        return x

    low = np.array([remainder(x) for x in range(1 << 12)], np.uint32)
    high = np.array([remainder(x << 12) for x in range(1 << 11)], np.uint32)
    errors = np.zeros(1 << 11, np.uint32)
    single = [1 << i for i in range(23)]
    patterns = [0, *single]
    patterns += [a | b for i, a in enumerate(single) for b in single[:i]]
    patterns += [a | b | c for i, a in enumerate(single) for j, b in enumerate(single[:i]) for c in single[:j]]
    for p in patterns:  # the code is perfect: every remainder has exactly one pattern of three errors or fewer
        errors[int(low[p & 4095] ^ high[p >> 12])] = p
    return low, high, errors


def golay_index(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Index (0 to 4095) of the codeword nearest to each 23-bit word."""
    low, high, errors = tables
    words = words.astype(np.uint32)
    return (words ^ errors[low[words & 4095] ^ high[words >> 12]]) >> 11


def golay_keys(prints: np.ndarray, tables: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): one exact segment joined to each codeword index near the next segment."""
    prints = prints.view(np.uint64)
    around = np.concatenate(([0], 1 << np.arange(23))).astype(np.uint32)
    parts = [(prints >> np.uint64(s)) & np.uint64((1 << w) - 1) for s, w in SEGMENTS]
    rows, keys = [], []
    for i in range(3):
        near = golay_index(parts[(i + 1) % 3].astype(np.uint32)[:, None] ^ around, tables)
        near.sort(axis=1)
        first = np.ones(near.shape, bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        row, col = np.nonzero(first)
        rows.append(row)
        keys.append((np.uint64(i) << np.uint64(60)) | (parts[i][row] << np.uint64(12)) | near[row, col].astype(np.uint64))
    return np.concatenate(rows), np.concatenate(keys).view(np.int64)


def star_links(rows: DataFrame, key: str, node: str) -> DataFrame:
    """(node, hub): each node tied to the smallest node that has the same key; one row a node and key at most."""
    dealt = rows.repartition(key)
    hub = dealt.groupBy(key).agg(F.min(node).alias("hub"), F.max(node).alias("__top")).where("hub != __top")
    return dealt.join(hub, key).select(node, "hub").distinct()


def linked_fingerprints(prints: DataFrame, name: str = "fp") -> DataFrame:
    """(node, label) of distinct fingerprints that differ in at most two bits from another."""

    def to_keys(batch: pa.RecordBatch):
        values = batch.column(0).to_numpy(zero_copy_only=False)
        row, key = golay_keys(values, golay_tables_once())
        return [pa.array(key), pa.array(values[row])]

    def to_words(batch: pa.RecordBatch):
        values = batch.column(0).to_numpy(zero_copy_only=False)
        flips = np.concatenate(([0], np.uint64(1) << np.arange(64, dtype=np.uint64))).astype(np.uint64)
        words = (values.view(np.uint64)[:, None] ^ flips).ravel().view(np.int64)
        return [pa.array(words), pa.array(np.repeat(values, 65))]

    keys = map_batches(prints.select(name), to_keys, "key bigint, node bigint")
    shares = star_links(keys, "key", "node")
    candidates = shared(shares.select("node").distinct(), "candidates")
    words = map_batches(candidates, to_words, "word bigint, node bigint")
    return components(star_links(words, "word", "node"), "node", "hub")


def golay_tables_once():
    store = worker_store()
    if not hasattr(store, "golay"):
        store.golay = golay_tables()
    return store.golay


def grouped(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Fingerprint of every row (doc_id, the columns ``keep``, fp), and of every distinct one its group (fp, label, component_id)."""
    rows = shared(with_fingerprints(df, text, [doc_id, *keep], width).withColumnRenamed(doc_id, "doc_id"), "fingerprints")
    prints = shared(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    tied = linked_fingerprints(prints)
    named = prints.join(tied, prints.fp == tied.node, "left").select("fp", "low", F.coalesce("label", "fp").alias("label"))
    named = named.repartition("label")
    lowest = named.groupBy("label").agg(F.min("low").alias("component_id"))
    return rows, shared(named.join(lowest, "label").select("fp", "label", "component_id"), "groups")


def simhash_components(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows, groups = grouped(df, text, doc_id, width)
    return rows.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
