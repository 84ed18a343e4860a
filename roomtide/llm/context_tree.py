"""Language-model scores by context-tree weighting.

A text is read as its words (A-Z in lower case), each followed by a blank, and one line feed at
the end. Every byte is eight binary decisions; the context of a byte is the six bytes before it
in this stream, whichever words they belong to (before the text begins they are zeros). For every
context of zero to six bytes and every place in the byte's binary tree there are two counts, a
Krichevsky-Trofimov estimate Pe from them, and the weighted probability

    Pw = Pe at full depth,   Pw = Pe / 2 + (product of the Pw of the longer contexts) / 2 above.

The probability of a decision mixes the estimates along the path by the share of Pe in Pw, so
all depths count, each as much as the training data supports it.

Training reads every byte of the corpus. Each task counts its seven-byte windows (context and
byte), packs those of a three-byte context into one row and deals the rows by that context. The
trees below different three-byte contexts are independent: a task walks its contexts in order and
keeps a bounded number of windows at a time, however often they occur. What lies above (contexts
of two bytes, of one and of none) has at most 2^24 places whatever the corpus, and goes to all
tasks. Windows that only held-out texts have are counted zero times, so every window has a score.

Scoring sends no text around: the most frequent windows (at most ``TOP_WINDOWS``, chosen by a
threshold on their counts) are known to every task, and a document sends its other windows to
meet the table of all. The add-one base works on words in the same way: the ``TOP_WORDS`` most
frequent words (of at most 64 bytes, so their table has a size bound) are known, of the others a
document sends (64-bit word hash, count).

Cases: a null text is empty and has the end token only; documents without an id have the
checksum of an empty id; repeated rows are scored each and all teach; without training tokens
every count is zero and the model is uniform over bits; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.common import LOWER, shared
from roomtide.llm.quality import fold

DEPTH = 6
SPLIT = 3  # trees are dealt by that many bytes of context
TOP_WINDOWS = 2_000_000
TOP_WORDS = 100_000
TOP_BYTES = 64
HELD_WORDS = 250_000  # distinct words a task counts before it hands them on
HELD_BYTES = 2 << 20  # bytes of text whose windows are made at once
SCORED_BYTES = 1 << 19  # bytes of text, but one text at least, that are scored at once; most arrays of that have eight bytes a byte
HELD_WINDOWS = 1_000_000  # distinct windows a task counts before it hands them on
GROWN_WINDOWS = 50_000  # windows whose trees are grown at once
END = b"\n"  # no word holds it; it stands for the end token


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(LOWER).split()


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word) - (1 << 63)


def count_words(docs: DataFrame) -> DataFrame:
    """word, train_count and in how many pieces it was met; words of held-out documents have count 0. The end token is a line feed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, other = Counter(), set()

        def handed() -> pa.RecordBatch:
            left = [w for w in other if w not in train]
            made = pa.RecordBatch.from_arrays(
                [pa.array([*train, *left], pa.binary()), pa.array([*train.values(), *[0] * len(left)], pa.int64())], names=["word", "n"]
            )
            train.clear()
            other.clear()
            return made

        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                words.append(END)
                if held:
                    other.update(words)
                else:
                    train.update(words)
                if len(train) + len(other) > HELD_WORDS:
                    yield handed()
        yield handed()

    parts = docs.select("text", "held_out").mapInArrow(run, "word binary, n bigint")
    return shared(parts.groupBy("word").agg(F.sum("n").alias("n")), "words")


def stream_of(words: list[bytes]) -> bytes:
    """The bytes that are coded: words, each followed by a blank, and the end."""
    return b" ".join(words)


def windows(streams: list[bytes], held: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the stream, code) of every byte, about ``held`` (``HELD_BYTES``) bytes at a time.

    A code holds the three nearest bytes of context, then the three before them, then the byte
    itself, so that codes in order keep a three-byte context together.
    """
    pad, held = b"\0" * DEPTH, held or HELD_BYTES
    parts, owners, size = [], [], 0

    def made() -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(p) - DEPTH for p in parts], np.int64)
        codes = np.zeros(len(data) - DEPTH, np.uint64)
        for back in (3, 2, 1, 6, 5, 4, 0):
            codes <<= np.uint64(8)
            codes |= data[DEPTH - back : len(data) - back]
        inside = np.ones(len(codes), bool)  # not those that end in the padding of the next part
        inside[(np.cumsum(sizes + DEPTH)[:-1, None] - np.arange(1, DEPTH + 1)).ravel()] = False
        return np.repeat(np.array(owners, np.int64), sizes), codes[inside]

    for owner, stream in enumerate(streams):
        whole = pad + stream
        for lo in range(0, len(stream), held):
            parts.append(whole[lo : lo + held + DEPTH])
            owners.append(owner)
            size += len(parts[-1]) - DEPTH
            if size >= held:
                yield made()
                parts, owners, size = [], [], 0
    if parts:
        yield made()


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts[order], first) if len(codes) else counts


def packed_rows(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """near (three bytes of context) and the rest of the codes with their counts, four bytes each, of ordered codes."""
    near = (codes >> np.uint64(32)).astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
    data = np.empty((len(codes), 2), np.uint32)
    data[:, 0], data[:, 1] = codes & np.uint64(0xFFFFFFFF), counts
    ends = np.append(first, len(codes)).astype(np.int32) * 8
    blobs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(near[first]), blobs], names=["near", "packed"])


def unpacked(near: pa.Array, packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if not len(packed):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    data = np.frombuffer(packed.buffers()[2], np.uint8)[ends[0] : ends[-1]].copy().view(np.uint32).reshape(-1, 2)
    upper = np.repeat(near.to_numpy(zero_copy_only=False).astype(np.uint64), np.diff(ends) // 8)
    return (upper << np.uint64(32)) | data[:, 0], data[:, 1].astype(np.int64)


def count_windows(docs: DataFrame) -> DataFrame:
    """near and packed: the windows of all texts, several rows a context; held-out texts count zero times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, read = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for batch in batches:
            by_fold: dict[bool, list[bytes]] = {False: [], True: []}
            for text, out in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                words.append(END)
                by_fold[bool(out)].append(stream_of(words))
            for out, streams in by_fold.items():
                for _, made in windows(streams):
                    each, n = np.unique(made, return_counts=True)
                    codes, counts = summed(np.concatenate([codes, each]), np.concatenate([counts, n * (not out)]))
                    read += len(made)
                    if len(codes) >= HELD_WINDOWS or read >= 1 << 31:  # a count fits in four bytes
                        yield packed_rows(codes, counts)
                        codes, counts, read = codes[:0], counts[:0], 0
        if len(codes):
            yield packed_rows(codes, counts)

    return docs.select("text", "held_out").mapInArrow(run, "near int, packed binary")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma by Stirling's series, shifted above 8."""
    x = x.astype(np.float64)
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        small = y < 8
        shift[small] += np.log(y[small])
        y[small] += 1
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln Pe of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def decisions(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight places in the binary tree of each byte (1 to 255) and the bits taken there."""
    k = np.arange(8)
    byte = byte.astype(np.int64)[:, None]
    return (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1


def subtrees(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Of windows that hold whole three-byte contexts: the eight mixed probabilities of each, and the nodes at depth three."""
    places, bits = decisions(codes & np.uint64(0xFF))
    weights = np.repeat(counts.astype(np.float64), 8)
    bits, places = bits.ravel(), places.ravel().astype(np.uint64)
    context = np.repeat((codes >> np.uint64(32)) | (((codes >> np.uint64(8)) & np.uint64(0xFFFFFF)) << np.uint64(24)), 8)
    mixed = below = parent_of = None
    for depth in range(DEPTH, SPLIT - 1, -1):
        key = ((context & np.uint64((1 << 8 * depth) - 1)) << np.uint64(8)) | places
        nodes, first, back = np.unique(key, return_index=True, return_inverse=True)
        n1 = np.bincount(back, weights * bits, len(nodes))
        n0 = np.bincount(back, weights, len(nodes)) - n1
        known = estimate(n0, n1)
        chance = (np.where(bits == 1, n1[back], n0[back]) + 0.5) / (n0[back] + n1[back] + 1.0)
        if mixed is None:
            mixed, total = chance, known
        else:
            longer = np.bincount(back[parent_of], below, len(nodes))
            total = np.logaddexp(known, longer) - np.log(2)
            share = np.exp(known - np.log(2) - total)[back]
            mixed = share * chance + (1 - share) * mixed
        below, parent_of = total, first
    return mixed.reshape(-1, 8), {"node": nodes, "n0": n0, "n1": n1, "total": total}


TREES = "code bigint, n bigint, chances array<double>, node bigint, n0 double, n1 double, total double"


def tree_rows(codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    mixed, nodes = subtrees(codes, counts)
    names = ["code", "n", "chances", "node", "n0", "n1", "total"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    ends = np.arange(0, mixed.size + 1, 8, dtype=np.int32)
    rows = [pa.array(codes.view(np.int64)), pa.array(counts), pa.ListArray.from_arrays(ends, pa.array(mixed.ravel()))]
    yield pa.RecordBatch.from_arrays([*rows, *(pa.nulls(len(codes), t) for t in kinds[3:])], names=names)
    made = [pa.array(nodes["node"].view(np.int64)), *(pa.array(nodes[c]) for c in names[4:])]
    yield pa.RecordBatch.from_arrays([*(pa.nulls(len(nodes["node"]), t) for t in kinds[:3]), *made], names=names)


def grow_trees(counted: DataFrame) -> DataFrame:
    """Rows of two kinds: code, n and chances of a window, or node, n0, n1 and total of a place under a three-byte context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, limit = 0, GROWN_WINDOWS
        for batch in batches:
            held.append(unpacked(batch.column(0), batch.column(1)))
            size += len(held[-1][0])
            if size < limit:
                continue
            codes, counts = summed(*(np.concatenate(c) for c in zip(*held)))
            near = codes >> np.uint64(32)
            whole = int(np.searchsorted(near, near[-1])) if len(near) else 0  # the last context may go on
            for lo, hi in slices(near[:whole]):
                yield from tree_rows(codes[lo:hi], counts[lo:hi])
            held = [(codes[whole:], counts[whole:])]
            size = len(codes) - whole
            limit = max(GROWN_WINDOWS, 2 * size)  # a context is summed up anew only when it has doubled
        if size:
            codes, counts = summed(*(np.concatenate(c) for c in zip(*held)))
            for lo, hi in slices(codes >> np.uint64(32)):
                yield from tree_rows(codes[lo:hi], counts[lo:hi])

    ordered = counted.repartition("near").sortWithinPartitions("near")
    return shared(ordered.mapInArrow(run, TREES), "trees")


def slices(near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``GROWN_WINDOWS`` rows that hold whole contexts."""
    lo = 0
    while lo < len(near):
        hi = min(len(near), lo + GROWN_WINDOWS)
        hi = int(np.searchsorted(near, near[hi - 1], "right"))
        yield lo, hi
        lo = hi


def upper_nodes(trees: DataFrame) -> DataFrame:
    """at (two context bytes and place), share of the estimate, chance of a one, n0, n1 and total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n0, n1, longer = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            known = estimate(n0, n1)
            total = np.logaddexp(known, longer) - np.log(2)
            made = [at, np.exp(known - np.log(2) - total), (n1 + 0.5) / (n0 + n1 + 1), n0, n1, total]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["at", "share", "one", "n0", "n1", "total"])

    # a node is (three context bytes, place); the two nearer bytes and the place remain
    above = trees.where("node is not null").groupBy(F.expr("node & 16777215").alias("at"))
    above = above.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("total").alias("longer"))
    return shared(above.mapInArrow(run, "at bigint, share double, one double, n0 double, n1 double, total double"), "upper")


def top_of_tree(trees: DataFrame) -> dict[str, np.ndarray]:
    """For two bytes of context (in order of ``at``), one (256 x 256) and none (256): the share of the estimate, and the chance of a one."""
    upper = upper_nodes(trees)
    two = upper.select("at", "share", "one").toArrow().sort_by("at")  # at most 2^24 rows
    above = upper.groupBy(F.expr("at & 65535").alias("at")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("total").alias("longer"))
    found = above.toArrow()
    at = found.column("at").to_numpy().astype(np.int64)
    n0, n1, longer = (np.zeros(1 << 16) for _ in range(3))
    for name, out in (("n0", n0), ("n1", n1), ("longer", longer)):
        out[at] = found.column(name).to_numpy()
    known = estimate(n0, n1)
    total = np.logaddexp(known, longer) - np.log(2)
    r0, r1 = n0.reshape(256, 256).sum(0), n1.reshape(256, 256).sum(0)
    root = estimate(r0, r1)
    root_total = np.logaddexp(root, total.reshape(256, 256).sum(0)) - np.log(2)
    return {
        "at2": two.column("at").to_numpy(), "share2": two.column("share").to_numpy(), "one2": two.column("one").to_numpy(),
        "share1": np.exp(known - np.log(2) - total), "one1": (n1 + 0.5) / (n0 + n1 + 1),
        "share0": np.exp(root - np.log(2) - root_total), "one0": (r1 + 0.5) / (r0 + r1 + 1),
    }


def window_scores(trees: DataFrame, top: dict[str, np.ndarray]) -> DataFrame:
    """code, n and log10 of the probability of its byte."""
    given = trees.sparkSession.sparkContext.broadcast(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = given.value
        for batch in batches:
            codes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            chance = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, 8)
            places, bits = decisions(codes & np.uint64(0xFF))
            near = (codes >> np.uint64(32)).astype(np.int64)[:, None]
            two = np.searchsorted(t["at2"], ((near & 0xFFFF) << 8) | places)
            one = ((near & 0xFF) << 8) | places
            for share, up in ((t["share2"][two], t["one2"][two]), (t["share1"][one], t["one1"][one]), (t["share0"][places], t["one0"][places])):
                chance = share * np.where(bits == 1, up, 1 - up) + (1 - share) * chance
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.log10(chance).sum(1))], names=["code", "n", "log_p"])

    windows = trees.where("code is not null").select("code", "n", "chances")
    return shared(windows.mapInArrow(run, "code bigint, n bigint, log_p double"), "window-scores")


def frequent_windows(scores: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes and scores of at most ``TOP_WINDOWS`` windows, the most frequent first: all whose count reaches a threshold."""
    step = F.floor(F.log2("n") * 8)
    steps = scores.where("n > 0").groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()  # under 512
    lowest, size = None, 0
    for row in steps:
        size += row.rows
        if size > TOP_WINDOWS:
            break
        lowest = row.step
    found = scores.where((F.col("n") > 0) & (step >= lowest) if lowest is not None else F.lit(False)).toArrow()
    order = np.lexsort([found.column("code").to_numpy(), -found.column("n").to_numpy()])
    return found.column("code").to_numpy().view(np.uint64)[order], found.column("log_p").to_numpy()[order]


class KnownWindows:
    """Scores of the frequent windows: tables with one window a slot, the more frequent one where two meet."""

    EMPTY = np.uint64((1 << 64) - 1)  # no code has 64 bits
    FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)  # any odd numbers

    def __init__(self, codes: np.ndarray, scores: np.ndarray):
        self.tables = []
        for factor in self.FACTORS:
            if not len(codes):
                break
            shift = np.uint64(64 - max(4, int(2 * len(codes) - 1).bit_length()))
            factor = np.uint64(factor)
            slot = (codes * factor) >> shift
            keys = np.full(1 << int(64 - shift), self.EMPTY, np.uint64)
            keys[slot[::-1]] = codes[::-1]
            values = np.zeros(len(keys))
            mine = keys[slot] == codes
            values[slot[mine]] = scores[mine]
            self.tables.append((factor, shift, keys, values))
            codes, scores = codes[~mine], scores[~mine]

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores (zero where not known) and the places of the codes that are not known."""
        out, left = np.zeros(len(codes)), np.arange(len(codes))
        for factor, shift, keys, values in self.tables:
            slot = (codes[left] * factor) >> shift
            met = keys[slot] == codes[left]
            out[left[met]] = values[slot[met]]
            left = left[~met]
        return out, left


DOCS = (
    "row_key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, n_bytes bigint, base double, score double, "
    "rare array<bigint>, times array<bigint>, far array<bigint>"
)


def read_documents(docs: DataFrame, words: dict[bytes, int], frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Sums over the frequent words and windows of every document, its other words as hashes and counts, its other windows as codes."""
    given = docs.sparkSession.sparkContext.broadcast((words, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        known, seen_windows = {w: (n, np.log10(n + 1.0)) for w, n in given.value[0].items()}, KnownWindows(*given.value[1])
        rows, streams = [], []

        def scored() -> pa.RecordBatch:
            scores, far, owners = np.zeros(len(rows)), [], []
            for owner, codes in windows(streams, SCORED_BYTES):
                found, left = seen_windows.find(codes)
                scores += np.bincount(owner, found, len(rows))
                far.append(codes[left])
                owners.append(owner[left])
            ends = np.append(0, np.cumsum(np.bincount(np.concatenate(owners), minlength=len(rows)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(far).view(np.int64)))
            made = list(zip(*rows))
            made.insert(7, scores)
            rows.clear()
            streams.clear()
            return pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(made, arrow)), lists.cast(arrow.field("far").type)], schema=arrow)

        size = 0
        for batch in batches:
            for doc, text, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                found = words_of(text.as_py())
                found.append(END)
                streams.append(stream_of(found))
                seen, base, rare, times = 0, 0.0, [], []
                for word, n in Counter(found).items():
                    met = known.get(word)
                    if met is None:
                        rare.append(word_hash(word))
                        times.append(n)
                    else:
                        seen += n * (met[0] > 0)
                        base += n * met[1]
                rows.append((number, doc, held, len(found), seen, len(streams[-1]), base, rare, times))
                number += 1
                size += len(streams[-1])
                if size >= SCORED_BYTES:
                    yield scored()
                    size = 0
        if rows:
            yield scored()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(DOCS))
    return shared(docs.select("doc_id", "text", "held_out").mapInArrow(run, DOCS), "document-words")


def word_keys(words: DataFrame) -> DataFrame:
    """word_key (hash) and n of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [word_hash(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(1)], names=["word_key", "n"])

    return words.select("word", "n").mapInArrow(run, "word_key bigint, n bigint")


def score_documents(df: DataFrame, text: str = "text", doc_id: str = "doc_id", folds: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every document."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), (fold(doc_id, folds) == held).alias("held_out"))
    words = count_words(docs)
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")).first()
    trees = grow_trees(count_windows(docs))
    scores = window_scores(trees, top_of_tree(trees))
    best = words.where(F.octet_length("word") <= TOP_BYTES).orderBy(F.desc("n"), "word").limit(TOP_WORDS).select("word", "n").toArrow()
    rows = read_documents(docs, dict(zip(best.column(0).to_pylist(), best.column(1).to_pylist())), frequent_windows(scores))
    rare = rows.select("row_key", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row_key", F.col("r.rare").alias("word_key"), F.col("r.times").alias("times"))
    sums = rare.join(word_keys(words), "word_key").groupBy("row_key").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("r_known"),
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("r_base"),
    )
    far = rows.select("row_key", F.explode("far").alias("code")).join(scores.select("code", "log_p"), "code")
    far = far.groupBy("row_key").agg(F.sum("log_p").alias("r_score"))
    every = rows.drop("rare", "times", "far").join(sums, "row_key", "left").join(far, "row_key", "left")
    space = float(np.log10(totals["n"] + totals["v"] + 1))
    score = F.col("score") + F.coalesce("r_score", F.lit(0.0))
    return every.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("r_known", F.lit(0))).alias("n_known"),
        F.lit(int(totals["n"])).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", F.lit(0.0)) - F.col("n_tokens") * space).alias("base_score"),
        score.alias("score"), (-score / float(np.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
