"""Benchmark decontamination by spaced seeds.

Tokens are runs of letters and digits in lower case. A mask picks six of up to nine tokens in
a row and ignores the others, so a substituted token costs only the seeds that pick it. The
three masks are chosen so that a window of twelve tokens with any two substitutions still has
a whole seed. Test items and documents are hashed under every mask and joined on the hash.

A leak is an ungapped overlap of a document and a test item with a window of twelve tokens of
which ten or more are equal (an item of seven to eleven tokens must occur whole). Every hit is
verified on the tokens around it, along its diagonal, and the overlap reported is the union of
all such windows. Any such overlap is found, because its window has a seed.

The documents' seeds are not shuffled: a bitmap of fixed size, made of all item seeds, thins
them in place, and only what passes is written and joined. The bitmap has 4 MB whatever the
number of items; with more items more seeds pass and the result stays the same.

Cases: null or short texts have no seeds and no leak; items of fewer than seven tokens are too
short to prove a leak; repeated rows and items add nothing to a pair (doc_id, item_id); pairs
with a null id keep it; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.common import mix, shared, word_hashes, word_spans

MASKS = ((0, 1, 2, 4, 6, 7), (0, 2, 3, 6, 7, 8), (0, 1, 2, 3, 5, 6))
WINDOW, EQUAL, SHORTEST = 12, 10, 7
AROUND = 24  # tokens kept on each side of a hit; a window that holds the hit reaches eleven
BITS = 25  # of a bitmap slot
CHUNK_BYTES = 1 << 20  # texts are hashed together up to this size; a longer one alone


def apart_bytes() -> np.ndarray:
    """Bytes between tokens: all of ASCII but letters and digits."""
    flags = np.zeros(256, bool)
    flags[:128] = True
    for low, high in ((48, 58), (65, 91), (97, 123)):
        flags[low:high] = False
    return flags


def tokens(data: bytes, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the tokens."""
    raw = np.frombuffer(data, np.uint8)
    starts, ends = word_spans(raw, apart)
    return starts, word_hashes(raw, starts, ends)


def seeds(hashes: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """The hash of every place where the mask fits."""
    n = len(hashes) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, number + 1, np.uint64)
    for k, at in enumerate(mask):
        total += hashes[at : at + n] * np.uint64(2 * (0x9E37 * (k + 1) ** 3 + 77) + 1)
    return mix(total)


def slots(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << BITS) - 1)
    return (values >> np.uint64(64 - BITS)).astype(np.int64), ((values >> np.uint64(8)) & low).astype(np.int64)


def normal(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def as_signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def list_array(parts: list[np.ndarray]) -> pa.Array:
    sizes = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(sizes, pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))


def item_rows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_no (a key of the row), item_id and the token hashes of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart, number = apart_bytes(), TaskContext.get().partitionId() << 40
        for batch in batches:
            found = [tokens(normal(t), apart)[1].view(np.int64) for t in batch.column(1).to_pylist()]
            keys = np.arange(number, number + len(found))
            number += len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0), list_array(found)], names=["item_no", "item_id", "item_tokens"])

    kept = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return shared(kept.mapInArrow(run, "item_no bigint, item_id bigint, item_tokens array<bigint>"), "items")


def item_seeds(items: DataFrame) -> DataFrame:
    """seed, its two bitmap slots, item_no and item_at, for every place of every mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = np.array(words, np.int64).view(np.uint64)
                for k, mask in enumerate(MASKS):
                    made = seeds(hashes, mask, k)
                    one, two = slots(made)
                    yield pa.RecordBatch.from_arrays(
                        [as_signed(made), pa.array(one), pa.array(two), pa.array(np.full(len(made), number)), pa.array(np.arange(len(made)))],
                        names=["seed", "slot1", "slot2", "item_no", "item_at"],
                    )

    rows = items.select("item_no", "item_tokens")
    return shared(rows.mapInArrow(run, "seed bigint, slot1 bigint, slot2 bigint, item_no bigint, item_at bigint"), "item-seeds")


def bitmap(found: DataFrame) -> np.ndarray:
    """All slots of the seeds as bits; 4 MB at any size of the table."""
    each = found.select(F.explode(F.array("slot1", "slot2")).alias("slot"))
    parts = each.groupBy(F.floor(F.col("slot") / 32768).alias("part")).agg(F.bitmap_construct_agg(F.pmod("slot", F.lit(32768))).alias("bits"))
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for row in parts.collect():
        out[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def segments(docs: DataFrame, bits: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stretches of documents around seeds that pass the bitmap, with their tokens and the seeds."""
    given = docs.sparkSession.sparkContext.broadcast(bits)

    def passes(slot: np.ndarray, table: np.ndarray) -> np.ndarray:
        return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 != 0

    def stretches(ids: list, texts: list[bytes], apart: np.ndarray, table: np.ndarray) -> Iterator[tuple]:
        """(doc_id, first token, tokens, places of seeds, seeds) of a few texts hashed together."""
        sizes = np.cumsum([0, *(len(t) + 1 for t in texts)])
        starts, hashes = tokens(b"\n".join(texts) + b"\n", apart)
        edges = np.searchsorted(starts, sizes)
        owner = np.repeat(np.arange(len(texts)), np.diff(edges))
        places, kept = [], []
        for k, mask in enumerate(MASKS):
            made = seeds(hashes, mask, k)
            one, two = slots(made)
            hit = np.flatnonzero(passes(one, table))
            hit = hit[passes(two[hit], table)]
            hit = hit[owner[hit] == owner[hit + mask[-1]]]
            places.append(hit)
            kept.append(made[hit])
        place, seed = np.concatenate(places), np.concatenate(kept)
        if not len(place):
            return
        order = np.argsort(place, kind="stable")
        place, seed = place[order], seed[order]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (owner[place[1:]] != owner[place[:-1]]) | (np.diff(place) > 2 * AROUND)
        cuts = np.append(np.flatnonzero(fresh), len(place))
        for a, b in zip(cuts[:-1], cuts[1:]):
            doc = owner[place[a]]
            low, high = max(edges[doc], place[a] - AROUND), min(edges[doc + 1], place[b - 1] + AROUND)
            yield ids[doc], int(low - edges[doc]), hashes[low:high].view(np.int64), place[a:b] - low, seed[a:b].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart, table, number = apart_bytes(), given.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, ids, texts, size = [], [], [], 0
            doc_ids, words = batch.column(0).to_pylist(), batch.column(1)
            for i, doc in enumerate(doc_ids):
                ids.append(doc)
                texts.append(normal(words[i].as_py()))
                size += len(texts[-1])
                if size >= CHUNK_BYTES or i + 1 == len(doc_ids):
                    rows += stretches(ids, texts, apart, table)
                    ids, texts, size = [], [], 0
            if rows:
                columns = list(zip(*rows))
                keys = np.arange(number, number + len(rows))
                number += len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *map(list_array, columns[2:])],
                    names=["segment", "doc_id", "first", "doc_tokens", "places", "seeds"],
                )

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    made = "segment bigint, doc_id bigint, first bigint, doc_tokens array<bigint>, places array<bigint>, seeds array<bigint>"
    return shared(kept.mapInArrow(run, made), "segments")


def overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """(first document token, tokens, equal tokens) of the overlap on a diagonal, if it is a leak."""
    low, high = max(0, shift), min(len(doc), len(item) + shift)
    same = doc[low:high] == item[low - shift : high - shift]
    width, needed = (WINDOW, EQUAL) if len(item) >= WINDOW else (len(item), len(item))
    if len(item) < SHORTEST or len(same) < width:
        return None
    total = np.concatenate(([0], np.cumsum(same)))
    good = np.flatnonzero(total[width:] - total[:-width] >= needed)
    if not len(good):
        return None
    covered = np.zeros(len(same) + 1, np.int64)
    np.add.at(covered, good, 1)
    np.add.at(covered, good + width, -1)
    inside = np.cumsum(covered)[:-1] > 0
    return low + int(good[0]), int(inside.sum()), int(same[inside].sum())


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The best overlap of every leaking pair: doc_id, item_id, doc_start, item_start, n_tokens and n_equal."""
    tests = item_rows(items)
    planted = item_seeds(tests)
    found = segments(docs, bitmap(planted), doc_id, text)
    hits = found.select("segment", F.explode(F.arrays_zip("places", "seeds")).alias("hit"))
    hits = hits.select("segment", F.col("hit.places").alias("place"), F.col("hit.seeds").alias("seed"))
    lines = hits.join(planted, "seed").select("segment", "item_no", (F.col("place") - F.col("item_at")).alias("shift")).distinct()
    pairs = lines.join(found.select("segment", "doc_id", "first", "doc_tokens"), "segment").join(tests, "item_no")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, item, first, shift, left, right in zip(*(batch.column(i).to_pylist() for i in range(6))):
                seen = overlap(np.array(left, np.int64), np.array(right, np.int64), shift)
                if seen:
                    rows.append((doc, item, first + seen[0], seen[0] - shift, seen[1], seen[2]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(6)], names=LEAK)

    leaks = pairs.select("doc_id", "item_id", "first", "shift", "doc_tokens", "item_tokens").mapInArrow(
        verify, ", ".join(f"{name} bigint" for name in LEAK)
    )
    best = F.max_by(F.struct("doc_start", "item_start", "n_tokens", "n_equal"), F.struct("n_equal", "n_tokens", -F.col("doc_start"), -F.col("item_start")))
    return leaks.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


LEAK = ["doc_id", "item_id", "doc_start", "item_start", "n_tokens", "n_equal"]
