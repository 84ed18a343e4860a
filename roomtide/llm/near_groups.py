"""Near-duplicate groups for filtering: rare shingles find pairs, the shingle sets decide.

Two texts are linked if the Jaccard likeness of their sets of five-word shingles is 0.8 or more;
groups are connected components. Every link counts, whatever the size of a group. The pipeline asks for the groups of
the SimHash operator first; what it has linked is not compared again.

Shingles have one order everywhere, seldom ones first. If two sets are that alike, their first
common shingle is among the first fifth of the larger and the first ninth of the smaller one, and
neither has too much before it. Texts that share a long passage therefore meet only if their other
shingles allow it. The order takes counts of ``SLOTS`` hash slots: they decide how many
pairs are looked at, never which links are found.

All that begin with a shingle first meet the smallest of them. Where one group holds them all
nothing is left to learn. Where not, the next ones of its first ninths meet those of other groups, in rounds of
four times as many each, until every one had its turn.

Cases: rows with equal texts are one document, null counts as empty; the row with the smallest
id stays; rows without an id are compared by equal text only; texts without words are alike; an
empty table stays empty; all columns of the rows that stay are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomtide.llm import simhash
from roomtide.llm.common import LOWER, components, least_difference, mix, parity, shared, white, word_hashes, word_spans

SHINGLE = 5
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
BLOCK = 1 << 12  # slots whose counts move in one row
NODE_SLOTS = 1 << 22
STEP = 4  # each round takes so many times the representatives of the one before


def shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """A hash of every run of ``width`` words; of all words where there are fewer."""
    n = len(words) - width + 1
    if len(words) == 0:
        return words
    span = width if n > 0 else len(words)
    n = max(n, 1)
    total = np.zeros(n, np.uint64)
    for k in range(span):
        total += words[k : k + n] * np.uint64(2 * (0x85EB * (k + 1) ** 3 + 13) + 1)
    return mix(total)


def shingle_set(text: str | None, apart: np.ndarray) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "replace").translate(LOWER), np.uint8)
    return np.unique(shingles(word_hashes(data, *word_spans(data, apart))))


def content(text: str):
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def slot_counts(docs: DataFrame, text: str) -> np.ndarray:
    """In each slot of shingle hashes, how many shingles the texts have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart, counts = white(), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for words in batch.column(0):
                counts += np.bincount((shingle_set(words.as_py(), apart) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=SLOTS)
        yield from packed(counts)

    def packed(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        codec, blocks = pa.Codec("zstd", 1), counts.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        rows = [codec.compress(blocks[k].astype("<i8").tobytes(), asbytes=True) for k in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(rows, pa.binary())], names=["block", "packed"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, counts = pa.Codec("zstd"), np.zeros(SLOTS, np.int64)
        blocks = counts.reshape(-1, BLOCK)
        for batch in batches:
            for k, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                blocks[k] += np.frombuffer(codec.decompress(row.as_py(), BLOCK * 8, asbytes=True), "<i8")
        yield from packed(counts)

    form = "block bigint, packed binary"
    found = docs.select(text).mapInArrow(run, form).repartition("block").mapInArrow(added, form).toArrow()
    codec, counts = pa.Codec("zstd"), np.zeros(SLOTS, np.int64)
    for k, row in zip(found.column("block").to_pylist(), found.column("packed").to_pylist()):
        counts.reshape(-1, BLOCK)[k] += np.frombuffer(codec.decompress(row, BLOCK * 8, asbytes=True), "<i8")
    return counts


def beginnings(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """node, digest, size of the shingle set, its first fifth, seldom ones first, and its parity, of every row."""
    given = docs.sparkSession.sparkContext.broadcast(slot_counts(docs, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart, counts = white(), given.value
        for batch in batches:
            sizes, ends, first, odd = [], [0], [], []
            for words in batch.column(2):
                own = shingle_set(words.as_py(), apart)
                size = len(own)
                sizes.append(size)
                odd.append(parity(own))
                if size:
                    order = np.argsort(counts[(own >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], kind="stable")  # ties by hash
                    first.append(own[order[: size - (4 * size + 4) // 5 + 1]])
                else:
                    first.append(np.zeros(1, np.uint64))  # where texts without words meet
                ends.append(ends[-1] + len(first[-1]))
            flat = np.concatenate(first).view(np.int64) if first else np.zeros(0, np.int64)
            begins = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            made = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), begins, pa.array(odd, pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=["node", "digest", "size", "begins", "parity"])

    rows = docs.select(F.col(doc_id).alias("node"), content(text).alias("digest"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "node bigint, digest string, size bigint, begins array<bigint>, parity binary")


def tied(spoken: DataFrame, prints: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, label) of the texts whose fingerprint is in the group of one with a smaller id.

    ``prints`` has digest and fp of every row, ``groups`` fp and label, as :func:`simhash.grouped` finds them.
    """
    named = spoken.select("digest", "node").join(prints.select("digest", "fp").distinct(), "digest").join(groups.select("fp", F.col("label").alias("group")), "fp")
    lowest = named.groupBy("group").agg(F.min("node").alias("label"))
    return named.join(lowest, "group").where("node > label").select("node", "label")


def meetings(spoken: DataFrame, known: DataFrame) -> DataFrame:
    """key, node, size, label, at and leads of every beginning shared with another text, and hub, the smallest that leads there."""
    every = spoken.select("node", F.posexplode("begins").alias("at", "key")).repartition("key")
    # most beginnings are of one text; all columns are read, so that both sides of the join are one exchange
    several = every.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("at").alias("last")).where("lo <> hi and last >= 0")
    labels = spoken.select("node", "size").join(known, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = shared(every.join(several.select("key"), "key"), "beginnings").join(labels, "node")
    rows = rows.withColumn("leads", F.expr("at < size - (8 * size + 8) div 9 + 1")).repartition("key")
    least = F.min(F.when(F.col("leads"), F.struct("size", "node", "at", "label"))).alias("hub")
    hubs = rows.groupBy("key").agg(least, F.count("*").alias("n")).where("n > 1 and hub is not null")
    return rows.join(hubs, "key")


# y leads and is not larger than x; what follows their common shingle still suffices for 0.8
MAY_LINK = (
    "(x.size > y.size or x.size = y.size and x.node > y.node) and 5 * y.size >= 4 * x.size "
    "and 9 * least(y.size - y.at, x.size - x.at) >= 4 * (x.size + y.size)"
)


def possible(pairs: DataFrame, spoken: DataFrame) -> DataFrame:
    """The pairs that the parities of their shingle sets allow to be alike: no other can be."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())
            kept = pa.array([9 * least_difference(left, right) <= size for left, right, size in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    sides = [spoken.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("parity").alias(f"odd_{c}")) for c in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "odd_a", "odd_b", (F.col("size_a") + F.col("size_b")).alias("size"))
    return both.mapInArrow(sift, "a bigint, b bigint")


def alike(pairs: DataFrame, docs: DataFrame, spoken: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The pairs whose shingle sets are alike; the sets of those that may be are compared."""
    pairs = shared(possible(pairs, spoken), "possible")
    slot = F.pmod(F.xxhash64("node"), F.lit(NODE_SLOTS))
    found = pairs.select(F.explode(F.array("a", "b")).alias("node")).select(slot.alias("slot")).distinct().toArrow()
    wanted = np.zeros(NODE_SLOTS, bool)  # spares the sets of most texts without a partner
    wanted[found.column("slot").to_numpy()] = True
    given = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart, flags = white(), np.unpackbits(given.value).astype(bool)
        for batch in batches:
            part = batch.filter(pa.array(flags[batch.column(3).to_numpy(zero_copy_only=False)]))
            sets = [shingle_set(words.as_py(), apart).tobytes() for words in part.column(2)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sets, pa.binary())], names=["node", "digest", "shingles"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2), batch.column(3)):
                one, two = np.frombuffer(left.as_py(), np.uint64), np.frombuffer(right.as_py(), np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                good.append(5 * both >= 4 * (len(one) + len(two) - both))
            kept = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("node"), content(text).alias("digest"), F.col(text).alias("text"))
    signed = rows.withColumn("slot", slot).mapInArrow(sign, "node bigint, digest string, shingles binary")
    sets = signed.join(spoken.select("node", F.col("digest").alias("said")), "node").where("digest = said").dropDuplicates(["node"])
    sets = shared(sets.select("node", "shingles"), "sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(verify, "a bigint, b bigint")


def linked_texts(docs: DataFrame, spoken: DataFrame, text: str, doc_id: str, known: DataFrame | None = None) -> DataFrame:
    """(node, label) of the texts linked to one with a smaller id; ``known`` has such links that need no comparison."""
    known = known if known is not None else spoken.select("node", F.col("node").alias("label")).limit(0)
    met = shared(meetings(spoken, known), "meetings")
    hub = met.alias("x").withColumn("y", F.col("hub")).where(f"x.label <> y.label and {MAY_LINK}")
    pairs = shared(hub.select(F.col("y.node").alias("a"), "x.node").toDF("a", "b").distinct(), "pairs")
    links = alike(pairs, docs, spoken, text, doc_id)
    groups = components(links.unionByName(known.select(F.col("label").alias("a"), F.col("node").alias("b"))))
    order = Window.partitionBy("key", "leads").orderBy("size", "node")
    more = met.where("n > 2").select("key", "node", "size", "at", "leads", F.when(F.col("leads"), F.row_number().over(order)).alias("turn"))
    more = shared(more, "more")
    done, now = 1, STEP
    while True:
        named = more.join(groups, "node", "left").withColumn("label", F.coalesce("label", "node"))
        ends = named.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.max("turn").alias("last"))
        undecided = ends.where(F.expr(f"l0 <> l1 and last > {done}")).select("key")
        left = shared(named.join(undecided, "key", "left_semi"), "undecided")
        if left.isEmpty():
            return groups
        turn = left.where(f"turn > {done} and turn <= {done + now}")
        pairs = turn.alias("y").join(left.alias("x"), F.expr(f"x.key = y.key and x.label <> y.label and {MAY_LINK}"))
        pairs = shared(pairs.select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct(), "pairs")
        if not pairs.isEmpty():
            links = alike(pairs, docs, spoken, text, doc_id)
            groups = components(groups.select(F.col("label").alias("a"), F.col("node").alias("b")).unionByName(links))
        # a key that one group holds, or whose texts all had their turn, needs no more
        more = left.select("key", "node", "size", "at", "leads", "turn")
        done, now = done + now, now * STEP


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", fingerprints: bool = False) -> DataFrame:
    """The rows of ``docs`` without those that copy, or nearly copy, one with a smaller id.

    With ``fingerprints`` the groups of the SimHash operator come first: their texts are linked, and the
    comparison of shingle sets adds the links that fingerprints miss.
    """
    texts = docs.select(content(text).alias("digest"), F.col(doc_id).alias("node")).groupBy("digest").agg(F.min("node").alias("node"))
    texts = shared(texts, "texts")
    # The first row of each text speaks for it; a null id takes no part.
    rows = beginnings(docs, text, doc_id).where("node is not null")
    first = rows.groupBy("digest").agg(F.min(F.struct("node", "size", "begins", "parity")).alias("first"))
    spoken = shared(first.select("first.node", "digest", "first.size", "first.begins", "first.parity"), "speakers")
    again = spoken.groupBy("node").agg(F.min("digest").alias("said"), F.max("digest").alias("other")).where("said <> other")
    again = shared(again.select("node", "said"), "again")
    if not again.isEmpty():  # an id of several texts speaks for one of them
        spoken = shared(spoken.join(again, "node", "left").where("said is null or said = digest").drop("said"), "speakers")
    known = None
    if fingerprints:
        prints, found = simhash.grouped(docs.withColumn("digest", content(text)), text, doc_id, keep=["digest"])
        known = shared(tied(spoken, prints, found), "tied")
    groups = linked_texts(docs, spoken, text, doc_id, known)
    later = groups.where("node > label").select("node")
    # digest and id as one key (a null id is left out of it), so that the texts move once
    stay = texts.join(later, "node", "left_anti").select(F.concat_ws(":", "digest", F.col("node").cast("string")).alias("__key"))
    marked = docs.withColumn("__key", F.concat_ws(":", content(text), F.col(doc_id).cast("string")))
    return marked.join(stay, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
