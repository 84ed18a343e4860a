"""Removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes when a string of ``length`` bytes that covers it starts anywhere else too. Every such
string has an anchor, the leftmost of its byte runs with the smallest hash, so equal strings have
equal anchors. The strings of one anchor place form a region, some 85 strings in 285 bytes, and
only regions that share an anchor can repeat each other. Regions are dealt by anchor; equal regions
travel once, with their number. A task joins the regions of its anchors to one text and forms its
Burrows-Wheeler transform; breadth-first backward extension then visits the intervals of all strings
in order of their length, and where an interval ends first, the common prefix of the two neighbours
has that length. The walk stops at ``length``: neighbours that no interval has parted by then begin
with the same string.

Texts never move. The first pass writes them, packed, to files of the shared folder and reports each
document's place; later passes read the documents they need there. Anchors are counted map-side. An
anchor with more different regions than one text should hold (a passage that many documents share,
each between other words) is cut into its single strings, which are counted by a 128-bit digest.

Cases: a null text is empty; texts shorter than ``length`` lose nothing; repeated ids and rows are
documents of their own (equal ones remove each other whole); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.llm.common import fast_list, mix, new_folder, open_folder, powers, shared

GRAM = 32  # bytes of an anchor
BLOCK = 1 << 20  # string starts looked at together
TEXT_BYTES = 1 << 20  # a transform takes whole anchors until it has that many bytes
REGIONS_IN_TEXT = 4_096  # anchors with more different regions are counted string by string
READ_BYTES = 8 << 20  # packed texts that one task reads back
SENTINEL = 256


# --- anchors -------------------------------------------------------------------


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbouring keys."""
    n = len(keys)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def regions_of(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Document, first start, number of starts and anchor of all regions of the texts ``data[bounds[i]:bounds[i+1]]``."""
    width = length - gram + 1
    found: list[tuple[np.ndarray, ...]] = []
    for low in range(0, max(0, int(bounds[-1]) - length + 1), BLOCK):
        part = data[low : low + BLOCK + length - 1]
        up, down = powers(len(part))
        running = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=running[1:])
        hashes = mix((running[gram:] - running[:-gram]) * down[: len(part) - gram + 1])
        # Equal hashes go to the left one: the place fills the lower half of the key.
        keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        place = (sliding_least(keys, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.arange(low, low + len(place))
        doc = np.searchsorted(bounds, starts, side="right") - 1
        good = np.flatnonzero(starts + length <= bounds[doc + 1])
        if not len(good):
            continue
        first = np.ones(len(good), bool)
        first[1:] = (place[good][1:] != place[good][:-1]) | (doc[good][1:] != doc[good][:-1])
        at = np.flatnonzero(first)
        number = np.diff(np.append(at, len(good)))
        head = good[at]
        found.append((doc[head], starts[head], number, hashes[place[head]].view(np.int64)))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(c) for c in zip(*found))


PLACES = "doc_id bigint, shard bigint, offset bigint, size bigint, n_bytes bigint, sha string, anchors array<bigint>, digests array<bigint>, starts array<bigint>, numbers array<bigint>"


def write_texts(df: DataFrame, folder: str, text: str, doc_id: str, length: int, gram: int) -> DataFrame:
    """Write the packed texts; a row per document with its place and its regions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        # The attempt's number is part of the file's name, so only files of finished tasks are ever read.
        shard, offset, sink = TaskContext.get().taskAttemptId(), 0, None
        packer = zstandard.ZstdCompressor(level=1)
        try:
            for batch in batches:
                for low in range(0, len(batch), 1_000):
                    ids = batch.column(0).slice(low, 1_000)
                    texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1).slice(low, 1_000).cast(pa.large_binary())]
                    if sink is None:
                        files, path = open_folder(f"{folder}/texts-{shard}.bin")
                        files.create_dir(path.rpartition("/")[0], recursive=True)
                        sink = files.open_output_stream(path, compression=None)
                    whole = b"".join(texts)
                    bounds = np.zeros(len(texts) + 1, np.int64)
                    np.cumsum([len(t) for t in texts], out=bounds[1:])
                    doc, start, number, anchor = regions_of(np.frombuffer(whole, np.uint8), bounds, length, gram)
                    view = memoryview(whole)
                    digest = [
                        xxhash.xxh3_64_intdigest(view[s : s + n + length - 1]) for s, n in zip(start.tolist(), number.tolist())
                    ]
                    digest = np.array(digest, np.uint64).view(np.int64)
                    cut = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
                    offsets, sizes = [], []
                    for t in texts:
                        packed = packer.compress(t)
                        sink.write(packed)
                        offsets.append(offset)
                        sizes.append(len(packed))
                        offset += len(packed)
                    lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(c)) for c in (anchor, digest, start - bounds[doc], number)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.cast(pa.int64()), pa.array([shard] * len(texts), pa.int64()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64()),
                            pa.array(np.diff(bounds)), pa.array([hashlib.sha256(t).hexdigest() for t in texts]), *lists,
                        ],
                        names=[c.split()[0] for c in PLACES.split(", ")],
                    )
        finally:
            if sink is not None:
                sink.close()

    return shared(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PLACES), "text-places")


class TextFiles:
    """Texts of the shared folder by place; the file that was read last stays open."""

    def __init__(self, folder: str):
        import zstandard

        self.folder, self.shard, self.source, self.unpack = folder, None, None, zstandard.ZstdDecompressor()

    def read(self, shard: int, offset: int, size: int) -> bytes:
        if shard != self.shard:
            files, path = open_folder(f"{self.folder}/texts-{shard}.bin")
            self.shard, self.source = shard, files.open_input_file(path)
        return self.unpack.decompress(self.source.read_at(size, offset))


# --- transform and interval expansion --------------------------------------------


def suffix_order(symbols: np.ndarray, region: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. A suffix ends at its region's sentinel; sentinels sort by region, below all bytes.

    ``left`` is the number of bytes before the sentinel. Ranks of the first seven bytes are doubled, and only
    suffixes still tied take part in the next round.
    """
    n = len(symbols)
    values = np.where(symbols == SENTINEL, 0, symbols + 1).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    padded = np.concatenate((values, np.zeros(7, np.uint64)))
    for k in range(7):
        key = key << np.uint64(9) | np.where(left >= k, padded[k : k + n], np.uint64(0))
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    parted = np.ones(n, bool)
    parted[1:] = key[order][1:] != key[order][:-1]
    heads = np.maximum.accumulate(np.where(parted, np.arange(n), 0))
    rank[order] = heads
    depth, regions = 7, int(region[-1]) + 1 if n else 0
    while True:
        alone = parted & np.append(parted[1:], True)
        tied = np.flatnonzero(~alone)
        if not len(tied):
            return order
        who = order[tied]
        # Tied suffixes within the depth are equal up to their sentinels, so their regions decide.
        ahead = np.minimum(who + depth, n - 1)
        second = np.where(left[who] < depth, region[who], regions + rank[ahead])
        first = rank[who]
        move = np.argsort(first * (n + regions + 1) + second, kind="stable")
        who, first, second = who[move], first[move], second[move]
        order[tied] = who
        fresh = np.ones(len(who), bool)
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        parted[tied] = fresh
        heads = np.maximum.accumulate(np.where(parted, np.arange(n), 0))
        rank[order] = heads
        depth *= 2


def parted_below(transform: np.ndarray, length: int) -> np.ndarray:
    """For every place 0..n of the order, whether the suffixes on both sides share fewer than ``length`` symbols.

    ``transform`` holds the symbol before each suffix, SENTINEL where a region begins. Intervals are
    taken level by level; extending one to the left by each of its symbols gives the intervals of the
    next level, and one whose end is already marked leads to nothing new.
    """
    n = len(transform)
    regions = int((transform == SENTINEL).sum())
    codes = transform.astype(np.int64) * (n + 1) + np.arange(n)
    codes = np.sort(codes[transform != SENTINEL])  # by symbol, then place: the k-th is the suffix at regions + k
    step = np.full(n, -1, np.int64)
    step[codes % (n + 1)] = regions + np.arange(len(codes))
    marked = np.zeros(n + 1, bool)
    marked[0] = marked[n] = True
    counts = np.bincount(transform[transform != SENTINEL], minlength=256)
    edges = regions + np.concatenate(([0], np.cumsum(counts)))
    used = np.flatnonzero(counts)
    # Strings of one symbol: each sentinel is one of its own.
    low = np.concatenate((np.arange(regions), edges[:-1][used]))
    high = np.concatenate((np.arange(regions) + 1, edges[1:][used]))
    marked[high] = True  # parted at level 0
    letters = used.astype(np.int64)
    for _ in range(1, length):
        if not len(low):
            break
        width = high - low
        one = width == 1
        lows, highs = [], []
        to = step[low[one]]
        to = to[to >= 0]
        lows.append(to)
        highs.append(to + 1)
        some = (width > 1) & (width <= 4 * len(letters))
        if some.any():
            sizes = width[some]
            owner = np.repeat(np.arange(len(sizes)), sizes)
            rows = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low[some], sizes)
            to = step[rows]
            real = to >= 0
            owner, to = owner[real], to[real]
            kind = owner * 256 + transform[rows[real]]
            order = np.argsort(kind, kind="stable")
            kind, to = kind[order], to[order]
            if len(kind):
                new = np.append(True, kind[1:] != kind[:-1])
                lows.append(to[new])
                highs.append(to[np.append(new[1:], True)] + 1)
        wide = width > 4 * len(letters)
        if wide.any():
            base = letters * (n + 1)
            down = np.searchsorted(codes, (base[:, None] + low[wide]).ravel())
            up = np.searchsorted(codes, (base[:, None] + high[wide]).ravel())
            real = up > down
            lows.append(regions + down[real])
            highs.append(regions + up[real])
        low, high = np.concatenate(lows), np.concatenate(highs)
        new = ~marked[high]
        low, high = low[new], high[new]
        marked[high] = True
    return marked


def repeated_starts(parts: list[bytes], weights: np.ndarray, length: int) -> list[np.ndarray]:
    """For every region, which of its strings of ``length`` bytes start anywhere else among the regions or their copies."""
    sizes = np.array([len(p) for p in parts])
    n = int(sizes.sum()) + len(parts)
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.full(n, SENTINEL, np.int64)
    is_byte = np.ones(n, bool)
    is_byte[ends] = False
    symbols[is_byte] = np.frombuffer(b"".join(parts), np.uint8)
    region = np.repeat(np.arange(len(parts)), sizes + 1)
    left = ends[region] - np.arange(n)
    order = suffix_order(symbols, region, left)
    marked = parted_below(symbols[order - 1], length)
    # A suffix that is not parted from a neighbour is no shorter than ``length``.
    again = np.empty(n, bool)
    again[order] = ~marked[:-1] | ~marked[1:]
    again |= (weights[region] > 1) & (left >= length)
    return [again[e - s : e - length + 1] for e, s in zip(ends.tolist(), sizes.tolist())]


# --- passes ----------------------------------------------------------------------


def region_bytes(regions: DataFrame, folder: str, length: int, parts: int) -> DataFrame:
    """anchor, digest, weight and content of the regions, read at one of their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, last, body = TextFiles(folder), None, b""
        for batch in batches:
            out = []
            for shard, offset, size, start, number in zip(*map(fast_list, batch.columns[:5])):
                if (shard, offset) != last:
                    last, body = (shard, offset), texts.read(shard, offset, size)
                out.append(body[start : start + number + length - 1])
            yield pa.RecordBatch.from_arrays([*batch.columns[5:], pa.array(out, pa.binary())], names=["anchor", "digest", "weight", "hot", "content"])

    rows = regions.select("place.*", "anchor", "digest", "weight", "hot")
    rows = rows.select("shard", "offset", "size", "start", "number", "anchor", "digest", "weight", "hot")
    dealt = rows.repartitionByRange(parts, "shard", "offset").sortWithinPartitions("shard", "offset")
    made = "anchor bigint, digest bigint, weight bigint, hot boolean, content binary"
    return shared(dealt.mapInArrow(run, made), "region-bytes")


def expand(contents: DataFrame, length: int) -> DataFrame:
    """anchor, digest and mask (a bit per string) of the regions, through transforms of whole anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve(rows: list[tuple]) -> pa.RecordBatch:
            flags = repeated_starts([r[3] for r in rows], np.array([r[2] for r in rows]), length)
            masks = [np.packbits(f).tobytes() for f in flags]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(masks, pa.binary())],
                names=["anchor", "digest", "mask"],
            )

        size = 0
        for batch in batches:
            for row in zip(*map(fast_list, batch.columns)):
                if size >= TEXT_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    rows = contents.select("anchor", "digest", "weight", "content")
    return rows.repartition("anchor").sortWithinPartitions("anchor", "digest").mapInArrow(run, "anchor bigint, digest bigint, mask binary")


def count_strings(contents: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many regions, by counting their single strings."""
    by = "anchor bigint, digest bigint, number bigint, place bigint, string binary, weight bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for low in range(0, len(batch), 1_000):
                made = []
                for anchor, digest, weight, content in zip(*(fast_list(c.slice(low, 1_000)) for c in batch.columns)):
                    number = len(content) - length + 1
                    made += [(anchor, digest, number, k, xxhash.xxh3_128_digest(content[k : k + length]), weight) for k in range(number)]
                kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], names=[c.split()[0] for c in by.split(", ")])

    strings = shared(contents.select("anchor", "digest", "weight", "content").mapInArrow(run, by), "hot-strings")
    often = shared(strings.groupBy("string").agg(F.sum("weight").alias("n")).where("n > 1").select("string"), "common-strings")
    hits = strings.join(often, "string").groupBy("anchor", "digest", "number").agg(F.collect_list("place").alias("places"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = []
            for number, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                flags = np.zeros(number, bool)
                flags[places] = True
                masks.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(masks, pa.binary())], names=["anchor", "digest", "mask"])

    return hits.mapInArrow(pack, "anchor bigint, digest bigint, mask binary")


def cut(marks: DataFrame, folder: str, length: int, parts: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of documents with repeated strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = TextFiles(folder)
        for batch in batches:
            rows = []
            for shard, offset, size, start, number, mask in zip(*(batch.column(i).to_pylist() for i in range(1, 7))):
                body = texts.read(shard, offset, size)
                change = np.zeros(len(body) + 1, np.int32)
                for s, n, m in zip(start, number, mask):
                    at = np.arange(s, s + n) if m is None else s + np.flatnonzero(np.unpackbits(np.frombuffer(m, np.uint8), count=n))
                    change[at] += 1  # no start twice in a region
                    change[at + length] -= 1
                gone = np.cumsum(change[:-1]) > 0
                kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                rows.append((len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            made = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    dealt = marks.repartitionByRange(parts, "shard", "offset").sortWithinPartitions("shard", "offset")
    return dealt.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(
    spark: SparkSession,
    df: DataFrame,
    length: int = 200,
    text: str = "text",
    doc_id: str = "doc_id",
    gram: int = GRAM,
    regions_in_text: int = REGIONS_IN_TEXT,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    gram = min(gram, length)
    folder = new_folder(spark, "texts")
    places = write_texts(df, folder, text, doc_id, length, gram)
    # Places are few bytes a document; the texts behind them say how many tasks there should be.
    parts = max(1, (places.agg(F.sum("size")).first()[0] or 0) // READ_BYTES)
    zipped = F.arrays_zip("anchors", "digests", "starts", "numbers")
    found = places.select("doc_id", "shard", "offset", "size", F.explode(zipped).alias("z")).select(
        "shard", "offset", "size", F.col("z.anchors").alias("anchor"), F.col("z.digests").alias("digest"),
        F.col("z.starts").alias("start"), F.col("z.numbers").alias("number"),
    )
    # Sums are written before they are joined: Spark can then split an anchor that very many texts share.
    common = shared(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "common-anchors")
    found = shared(found.join(common, "anchor"), "shared-regions")

    regions = found.groupBy("anchor", "digest").agg(
        F.count("*").alias("weight"), F.min(F.struct("shard", "offset", "size", "start", "number")).alias("place")
    )
    regions = shared(regions, "regions")
    variants = shared(regions.groupBy("anchor").agg(F.count("*").alias("variants")).where("variants > 1"), "variants")
    mixed = regions.join(variants, "anchor").withColumn("hot", F.col("variants") > regions_in_text)
    contents = region_bytes(mixed, folder, length, parts)
    masks = expand(contents.where("not hot"), length).unionByName(count_strings(contents.where("hot"), length))
    # A region whose anchor has no other region repeats as a whole.
    whole = regions.join(variants, "anchor", "left_anti").select("anchor", "digest", F.lit(None).cast("binary").alias("mask"))
    known = shared(masks.unionByName(whole), "region-masks")

    marks = found.join(known, ["anchor", "digest"])
    marks = marks.where("mask is null or mask != cast(repeat('\\0', length(mask)) as binary)")
    per_text = marks.groupBy("shard", "offset").agg(F.collect_list(F.struct("start", "number", "mask")).alias("marks"))
    heads = places.select("doc_id", "shard", "offset", "size", "n_bytes", "sha")
    joined = shared(heads.join(per_text, ["shard", "offset"], "left"), "text-marks")
    clean = joined.where("marks is null").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256")
    )
    dirty = joined.where("marks is not null").select(
        "doc_id", "shard", "offset", "size", F.col("marks.start").alias("start"), F.col("marks.number").alias("number"), F.col("marks.mask").alias("mask")
    )
    return clean.unionByName(cut(dirty, folder, length, parts))
