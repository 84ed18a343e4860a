"""Document fingerprints by MinHash.

The words of a text give five-word shingles (all words where there are fewer); 128 universal
permutations h(x) = a x + b modulo 2^64 run over all shingles at once in numpy and keep the
smallest value each. A fingerprint is one byte of every minimum; likeness is the share of equal
bytes, corrected for chance agreement.

Comparing a document to the next one and to its edited text needs neighbours in id order only.
Documents are dealt to ranges of the id once, in descending order, with compressed texts; each task
walks its range with one row of lookahead. The last row of a range meets the first of the next one
through a small table with one row per range.

Classes of near-equal texts come from the bands of the fingerprints: texts that share one are
joined, and linked where the exact Jaccard likeness of their shingle sets is 0.8 or more. Classes are
connected components. The hub of a bucket is the text that shares bands most often; every text meets
one hub, that with which it shares most bands. The texts of buckets that are not one class after this are
compared by the seldom shingles that two sets so alike must share (see ``near_groups``), which finds every
link that is left and lists no pairs of texts that share only what is common. No bucket is capped, none is
kept in one task. A link can only be missed where no band is equal (5e-8 at likeness 0.8).

Cases: a null text is empty and has the fingerprint of no shingles; equal texts have equal
fingerprints, one class, and two empty ones likeness 1; texts without words are alike; repeated ids
are ordered by the digest of the text and are each other's neighbours; null ids come last and take
part in classes, whose id is the smallest of the ids there are (null if none); a single row is its own
next row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomtide.llm import near_groups
from roomtide.llm.common import LOWER, components, mix, shared, white, word_hashes, word_spans

PERMUTATIONS = 128
SHINGLE = 5
BANDS = 32  # of four minima: likeness 0.8 shares one with all but 5e-8
BAND_BYTES = 6
BROADCAST_TEXTS = 500_000  # rows of 32 bytes; more of them are joined by a shuffle
HUB_SETS = 64  # shingle sets of hubs that a task keeps


def permutations(count: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets, the same in every task."""
    numbers = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:count, None] | np.uint64(1), numbers[count:, None]


def shingle_hashes(text: str, apart: np.ndarray) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8", "replace").translate(LOWER), np.uint8)
    words = word_hashes(data, *word_spans(data, apart))
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return mix(np.array([np.sum(words * (np.arange(len(words), dtype=np.uint64) * np.uint64(2) + np.uint64(3)))], np.uint64)) if len(words) else words
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total += words[k : k + n] * np.uint64(2 * (0xC2B2 * (k + 1) ** 3 + 29) + 1)
    return mix(total)


def minima(hashes: np.ndarray, given: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The smallest value of each permutation; the largest number where there is no shingle."""
    factor, offset = given
    out = np.full(len(factor), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), 512):
        np.minimum(out, (hashes[k : k + 512] * factor + offset).min(axis=1), out=out)
    return out


def fingerprint(lowest: np.ndarray) -> np.ndarray:
    return (mix(lowest) >> np.uint64(56)).astype(np.uint8)


def band_hashes(lowest: np.ndarray) -> bytes:
    """Six bytes of a hash of the four whole minima of every band: unlike texts hardly ever share one, whatever the corpus."""
    four = lowest.reshape(BANDS, -1)
    factors = np.arange(1, 2 * four.shape[1], 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix((four * factors).sum(axis=1, dtype=np.uint64)).view(np.uint8).reshape(BANDS, 8)[:, :BAND_BYTES].tobytes()


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Estimated Jaccard likeness: equal bytes, less those that agree by chance."""
    share = float((left == right).mean())
    return max(0.0, (share - 1 / 256) / (1 - 1 / 256))


class Texts:
    """Fingerprints of texts and of texts with another ending."""

    def __init__(self):
        self.given, self.apart = permutations(), white()

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        hashes = shingle_hashes(text, self.apart)
        return hashes, minima(hashes, self.given)

    def compare(self, text: str, hashes: np.ndarray, lowest: np.ndarray, following: str, next_lowest: np.ndarray) -> tuple:
        """n_chars, edited_sha256, the two fingerprints, near_edited and near_next."""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        own, other = fingerprint(lowest), fingerprint(next_lowest)
        changed = fingerprint(minima(shingle_hashes(edited, self.apart), self.given)) if edited != text else own
        digest = hashlib.sha256(edited.encode("utf-8", "replace")).digest()
        return len(text), digest, own.tobytes(), changed.tobytes(), likeness(own, changed), likeness(own, other)


COLUMNS = ["range_no", "doc_id", "n_chars", "edited_sha256", "own", "changed", "near_edited", "near_next", "first_text", "last_text", "digest", "bands"]
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.binary(), pa.binary()]
MADE = (
    "range_no bigint, doc_id bigint, n_chars bigint, edited_sha256 binary, own binary, changed binary, "
    "near_edited double, near_next double, first_text string, last_text string, digest binary, bands binary"
)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=COLUMNS)


def content(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, texts, compressed: a third of the bytes to move."""
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        texts = [(t.as_py() or "").encode("utf-8", "replace") for t in batch.column(batch.num_columns - 1)]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        packed = pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes, packed], names=[*batch.schema.names[:-1], "size", "packed"])


def unpack(packed: bytes, size: int) -> str:
    return pa.Codec("zstd").decompress(packed, size, asbytes=True).decode("utf-8") if size else ""


def compared(df: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """The columns of ``MADE`` of every row, and node, digest and bands of every row."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, texts, before, first = TaskContext.get().partitionId(), Texts(), None, None
        for batch in batches:
            rows = []
            ids, digests, sizes, packed = (batch.column(i) for i in range(4))
            for doc, digest, size, small in zip(ids.to_pylist(), digests.to_pylist(), sizes.to_pylist(), packed):
                now = unpack(small.as_py(), size)
                hashes, lowest = texts.of(now)
                if before is None:
                    first = now
                else:
                    rows.append((number, before[0], *texts.compare(*before[2:], now, lowest), None, None, before[1], band_hashes(before[4])))
                before = (doc, digest, now, hashes, lowest)
            if rows:
                yield batch_of(rows)
        if before is not None:  # the last row waits for the first of the next range
            own, bands = fingerprint(before[4]).tobytes(), band_hashes(before[4])
            yield batch_of([(number, before[0], None, None, own, None, None, None, first, before[2], before[1], bands)])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = Texts()
        for batch in batches:
            rows = []
            for number, doc, last, following, digest in zip(*(batch.column(i).to_pylist() for i in range(5))):
                rows.append((number, doc, *texts.compare(last, *texts.of(last), following, texts.of(following)[1]), None, None, digest, None))
            if rows:
                yield batch_of(rows)

    dealt = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), content(text).alias("digest"), F.col(text).alias("text"))
    dealt = dealt.mapInArrow(pack, "doc_id bigint, digest binary, size bigint, packed binary")
    order_by = F.desc_nulls_last("doc_id"), F.asc("digest")
    dealt = dealt.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    rows = shared(dealt.mapInArrow(walk, MADE), "fingerprints")
    edges = rows.where("last_text is not null")
    numbers = edges.select("range_no")
    order = Window.orderBy("range_no")  # a number per range
    after = numbers.select(F.col("range_no").alias("here"), F.lead("range_no").over(order).alias("there"))
    after = after.crossJoin(numbers.agg(F.min("range_no").alias("lowest"))).select("here", F.coalesce("there", "lowest").alias("there"))
    heads = edges.select(F.col("range_no").alias("there"), F.col("first_text").alias("following"))
    tails = edges.select(F.col("range_no").alias("here"), "doc_id", "last_text", "digest")
    pairs = tails.join(after, "here").join(heads, "there").select("here", "doc_id", "last_text", "following", "digest")
    whole = rows.where("last_text is null").unionByName(pairs.mapInArrow(finish, MADE))
    return whole, rows.select(F.col("doc_id").alias("node"), "digest", "bands")


FINGERPRINT_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def spelled(rows: DataFrame) -> DataFrame:
    named = {"edited_sha256": "edited_sha256", "fingerprint": "own", "edited_fingerprint": "changed"}
    return rows.withColumns({name: F.lower(F.hex(made)) for name, made in named.items()})


def fingerprints(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row."""
    return spelled(compared(df, text, doc_id)[0]).select(FINGERPRINT_COLUMNS)


def fingerprints_and_classes(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The columns of :func:`fingerprints`, and class_id and class_texts of :func:`near_duplicates`."""
    rows, signed = compared(df, text, doc_id)
    rows = rows.drop("range_no", "first_text", "last_text", "bands")
    return spelled(rows.join(classes(df, signed, text, doc_id), "digest")).select(*FINGERPRINT_COLUMNS, "class_id", "class_texts")


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, class_id (smallest id of the class) and class_texts (its different texts) of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = Texts()
        for batch in batches:
            bands = pa.array([band_hashes(texts.of(words.as_py() or "")[1]) for words in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bands], names=["node", "digest", "bands"])

    rows = df.select(F.col(doc_id).cast("bigint").alias("node"), content(text).alias("digest"), F.col(text).alias("text"))
    signed = shared(rows.mapInArrow(sign, "node bigint, digest binary, bands binary"), "signatures")
    found = signed.join(classes(df, signed, text, doc_id), "digest")
    return found.select(F.col("node").alias("doc_id"), "class_id", "class_texts")


def classes(df: DataFrame, signed: DataFrame, text: str, doc_id: str) -> DataFrame:
    """digest, class_id and class_texts of every different text; ``signed`` has node, digest and bands of every row."""
    texts = signed.groupBy("digest").agg(F.min("node").alias("node"), F.min("bands").alias("bands"))
    texts = shared(texts.withColumn("id", F.monotonically_increasing_id()), "texts")  # short numbers, fixed by the table
    labels = texts.select("digest", "node", "id").join(linked(df, texts, text, doc_id), "id", "left")
    labels = labels.withColumn("label", F.coalesce("label", "id"))
    sizes = labels.groupBy("label").agg(F.min("node").alias("class_id"), F.count("*").alias("class_texts"))
    return labels.join(sizes, "label").select("digest", "class_id", "class_texts")


def band_keys(texts: DataFrame) -> DataFrame:
    """id and key of every band of every text."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.shiftrightunsigned(F.xxhash64(k, F.substring("bands", k * BAND_BYTES + 1, F.lit(BAND_BYTES))), 8),
    )
    return texts.select("id", F.explode(keys).alias("key"))


def buckets(texts: DataFrame) -> DataFrame:
    """key, id and n (its texts) of every band that several texts share."""
    keys = band_keys(texts).repartition("key")
    # most bands are of one text; both columns are read, so that both sides of the join are one exchange
    several = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    return keys.join(several.select("key", "n"), "key")


def hub_pairs(met: DataFrame) -> DataFrame:
    """b, each text of a bucket that is not its hub, and a, the hub with which it shares most bands; ``met`` as of :func:`buckets`."""
    weights = met.groupBy("id").agg(F.sum("n").alias("weight"))  # the text that others were made from has most
    most = F.max(F.struct("weight", (-F.col("id")).alias("least")))
    hubs = met.join(weights, "id").groupBy("key").agg(most.alias("hub")).select("key", (-F.col("hub.least")).alias("hub"))
    shares = met.join(hubs, "key").where("id <> hub").groupBy(F.col("id").alias("b"), F.col("hub").alias("a")).agg(F.count("*").alias("bands"))
    return shares.groupBy("b").agg(F.max(F.struct("bands", "a")).alias("best")).select("best.a", "b")


def packed_texts(wanted: DataFrame, df: DataFrame, texts: DataFrame, text: str, doc_id: str) -> DataFrame:
    """id, size and packed (compressed) of the texts with the ids ``wanted``; only these are read into the join."""
    wanted = shared(texts.select("id", "digest", "node").join(wanted, "id"), "wanted").select(F.col("id"), F.col("digest").alias("_d"), F.col("node").alias("_n"))
    if wanted.count() <= BROADCAST_TEXTS:  # their keys go to all tasks, so that the other texts stay where they are
        wanted = F.broadcast(wanted)
    rows = df.select(content(text).alias("digest"), F.col(doc_id).cast("bigint").alias("node"), F.col(text).alias("text"))
    spoken = rows.join(wanted, (F.col("digest") == F.col("_d")) & F.col("node").eqNullSafe(F.col("_n")))
    packed = spoken.select("id", "text").mapInArrow(pack, "id bigint, size bigint, packed binary")
    return shared(packed.dropDuplicates(["id"]), "packed")  # rows may be repeated


def unpacked(packed: DataFrame) -> DataFrame:
    """id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [unpack(small.as_py(), size) for size, small in zip(batch.column(1).to_pylist(), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return packed.select("id", "size", "packed").mapInArrow(run, "id bigint, text string")


def verified(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    """The pairs a, b whose shingle sets are alike; ``packed`` as of :func:`packed_texts`."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart, kept_sets = white(), {}
        for batch in batches:
            good = []
            for a, size, left, other, right in zip(*(batch.column(i) for i in (0, 2, 3, 4, 5))):
                a = a.as_py()
                one = kept_sets.get(a)
                if one is None:
                    if len(kept_sets) >= HUB_SETS:
                        kept_sets.clear()
                    one = kept_sets[a] = np.unique(shingle_hashes(unpack(left.as_py(), size.as_py()), apart))
                two = np.unique(shingle_hashes(unpack(right.as_py(), other.as_py()), apart))
                both = len(np.intersect1d(one, two, assume_unique=True))
                good.append(5 * both >= 4 * (len(one) + len(two) - both))
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    sides = [packed.select(F.col("id").alias(c), F.col("size").alias(f"size_{c}"), F.col("packed").alias(f"text_{c}")) for c in "ab"]
    both = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b").select("a", "b", "size_a", "text_a", "size_b", "text_b")
    return both.mapInArrow(verify, "a bigint, b bigint")


def linked(df: DataFrame, texts: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(id, label) of the texts linked to one with a smaller id."""
    met = shared(buckets(texts), "buckets")
    packed = packed_texts(met.select("id").distinct(), df, texts, text, doc_id)
    links = verified(shared(hub_pairs(met), "pairs"), packed)
    known = components(links)
    named = met.join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    ends = named.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1")
    ids = met.join(ends.select("key"), "key", "left_semi").select("id").distinct()
    rest = shared(packed.join(ids, "id", "left_semi"), "undecided")
    if rest.isEmpty():
        return known.withColumnRenamed("node", "id")
    rest = unpacked(rest)
    spoken = shared(near_groups.beginnings(rest, "text", "id"), "speakers")
    return near_groups.linked_texts(rest, spoken, "text", "id", known).withColumnRenamed("node", "id")
