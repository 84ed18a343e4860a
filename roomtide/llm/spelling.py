"""Spelling variants by k-d trees over letter-count vectors.

Words are counted per batch and summed by Spark. One inserted or deleted letter moves the vector of
letter counts by one, one replaced letter by two (L1), so the near words of a word lie in a box of
that radius: radius two among the words of its own length, one among those a letter longer or shorter.

The words of each length are split along letter counts into the cells of a k-d tree, as many as there
are words for. The upper levels are laid out from a bounded sample of the words (``SAMPLE_WORDS``);
they only decide how even the cells are. Every word is a point of one cell and a query in all cells
that its radius reaches, so cells are pruned before anything is shuffled. A task builds the tree of
one cell at a time, streams its queries through it, prunes by the boxes of the inner nodes, compares
the vectors in the leaves and verifies the order of the letters of what is left. It returns one row
per query and cell: the number of near words and the best of them. Roots follow from joins that
double the length of the path in each round; a form is at least twice as frequent, so paths are short.

Cases: a null text has no words; a null id counts as an empty text before the colon; repeated rows
count again; ties between forms go to the smallest in code-point order; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.common import fast_list, shared

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
FLUSH_WORDS = 300_000
SAMPLE_WORDS = 200_000
HASHES = 1 << 30
CELL_WORDS = 32_768
LEAF_WORDS = 128
AXES = 26 + 64  # a to z, then U+00C0 to U+00FF
PAIRS_AT_ONCE = 1 << 18


@dataclass(frozen=True)
class Settings:
    least_length: int = 5
    least_count: int = 3
    every: int = 97  # one of so many (document, word) pairs loses a letter; 0: none
    ratio: int = 2


# --- words -----------------------------------------------------------------------


def count_words(df: DataFrame, settings: Settings, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word and n of all words that are long and frequent enough."""
    least, every = settings.least_length, settings.every

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for doc, words in zip(batch.column(0).to_pylist(), fast_list(batch.column(1))):
                if not words:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                lowered = words.encode("utf-8", "replace").lower().decode()
                for run_, n in Counter(w for w in RUNS.findall(lowered) if len(w) >= least).items():
                    if every and (h := zlib.crc32(run_.encode(), start)) % every == 0:
                        cut = h % len(run_)
                        run_ = run_[:cut] + run_[cut + 1 :]
                        if len(run_) < least:
                            continue
                    total[run_] += n
                if len(total) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "word string, n bigint")
    counted = rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least_count)
    return shared(counted, "words")


def codes_of(words: list[str], length: int) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint16).reshape(len(words), length)


def vectors_of(codes: np.ndarray) -> np.ndarray:
    """How often each letter occurs, at most 255 (which keeps distances no larger than they are)."""
    axis = np.where(codes < 0xC0, codes - ord("a"), codes - 0xC0 + 26).astype(np.int64)
    n = len(codes)
    flat = np.bincount((np.arange(n)[:, None] * AXES + axis).ravel(), minlength=n * AXES)
    return np.minimum(flat.reshape(n, AXES), 255).astype(np.uint8)


def signatures_of(vectors: np.ndarray) -> np.ndarray:
    """64 bits whose Hamming distance is never above the L1 distance: two unary bits per plain letter, a parity bit per group of others."""
    made = np.zeros(len(vectors), np.uint64)
    for letter in range(26):
        made |= (vectors[:, letter] >= 1).astype(np.uint64) << np.uint64(2 * letter)
        made |= (vectors[:, letter] >= 2).astype(np.uint64) << np.uint64(2 * letter + 1)
    for group in range(12):
        parity = vectors[:, 26 + group :: 12].sum(1, dtype=np.int64) & 1
        made |= parity.astype(np.uint64) << np.uint64(52 + group)
    return made


# --- trees -----------------------------------------------------------------------


@dataclass
class Node:
    """An inner node sends counts of ``axis`` up to ``limit`` to the left; a leaf has a number."""

    axis: int = -1
    limit: int = 0
    left: Node | None = None
    right: Node | None = None
    leaf: int = -1


def grow(vectors: np.ndarray, most: float, leaves: list[np.ndarray], rows: np.ndarray | None = None) -> Node:
    """A tree whose leaves hold at most ``most`` points, unless all have one vector. ``leaves`` gets the points of each."""
    rows = np.arange(len(vectors)) if rows is None else rows
    if len(rows) > max(1, most):
        part = vectors[rows]
        best = (0, 0, 0)
        for axis in np.flatnonzero(part.max(0) > part.min(0)):
            below = np.cumsum(np.bincount(part[:, axis]))[:-1]
            even = np.minimum(below, len(rows) - below)
            limit = int(even.argmax())
            best = max(best, (int(even[limit]), -int(axis), limit))
        if best[0] > 0:
            axis, limit = -best[1], best[2]
            small = part[:, axis] <= limit
            return Node(axis, limit, grow(vectors, most, leaves, rows[small]), grow(vectors, most, leaves, rows[~small]))
    leaves.append(rows)
    return Node(leaf=len(leaves) - 1)


def reach(node: Node, vectors: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Leaf and queries of all pairs whose L1 distance to the leaf's box is at most ``radius``."""

    def walk(node: Node, rows: np.ndarray, far: np.ndarray, per: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        if not len(rows):
            return
        if node.leaf >= 0:
            yield node.leaf, rows
            return
        own = vectors[rows, node.axis].astype(np.int64)
        before = per.get(node.axis)
        for child, gap in ((node.left, own - node.limit), (node.right, node.limit + 1 - own)):
            gap = np.maximum(gap, 0) if before is None else np.maximum(gap, before)
            total = far + gap - (0 if before is None else before)
            near = total <= radius
            if near.all():
                yield from walk(child, rows, total, per | {node.axis: gap})
            else:
                yield from walk(child, rows[near], total[near], {a: d[near] for a, d in per.items()} | {node.axis: gap[near]})

    yield from walk(node, np.arange(len(vectors)), np.zeros(len(vectors), np.int64), {})


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows of code points differ by exactly one edit; ``b`` is as long or one longer."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(1) == 1
    front = np.cumprod(a == b[:, :length], axis=1, dtype=np.uint8).sum(1, dtype=np.int64)
    back = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(1, dtype=np.int64)
    return front + back >= length


class Cell:
    """The points of one cell and their tree."""

    def __init__(self, words: list[str], counts: list[int]):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words = [words[i] for i in order]  # the smaller place is the smaller word
        self.counts = np.array([counts[i] for i in order], np.int64)
        self.length = len(words[0])
        self.codes = codes_of(self.words, self.length)
        vectors = vectors_of(self.codes)
        self.signs = signatures_of(vectors)
        self.leaves: list[np.ndarray] = []
        self.root = grow(vectors, LEAF_WORDS, self.leaves)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Query and point of all near pairs; the queries have one length."""
        codes = codes_of(words, len(words[0]))
        vectors = vectors_of(codes)
        signs = signatures_of(vectors)
        radius = 2 if len(words[0]) == self.length else 1
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for leaf, rows in reach(self.root, vectors, radius):
            points = self.leaves[leaf]
            step = max(1, PAIRS_AT_ONCE // len(points))
            for low in range(0, len(rows), step):
                part = rows[low : low + step]
                hit = np.flatnonzero(np.bitwise_count(signs[part][:, None] ^ self.signs[points][None, :]) <= radius)
                if len(hit):
                    found.append((part[hit // len(points)], points[hit % len(points)]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, p = (np.concatenate(c) for c in zip(*found))
        good = np.zeros(len(q), bool)
        step = max(1, (1 << 22) // (self.length + 1))
        for low in range(0, len(q), step):
            a, b = codes[q[low : low + step]], self.codes[p[low : low + step]]
            good[low : low + step] = one_edit(a, b) if a.shape[1] <= b.shape[1] else one_edit(b, a)
        return q[good], p[good]

    def answers(self, words: list[str]) -> list[tuple[str, int, int, str]]:
        """word, number of near points, the largest count among them and the smallest word that has it."""
        q, p = self.near(words)
        if not len(q):
            return []
        order = np.lexsort((p, -self.counts[p], q))
        q, p = q[order], p[order]
        first = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
        numbers = np.diff(np.append(first, len(q)))
        return [(words[a], int(n), int(self.counts[b]), self.words[b]) for a, b, n in zip(q[first], p[first], numbers)]


# --- passes ----------------------------------------------------------------------


def lay_out(words: DataFrame, cell_words: int) -> dict[int, tuple[Node, int]]:
    """The upper tree of every length and the number of its first cell; as many cells as the words need."""
    totals = {r["length"]: r["n"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    # Words with the smallest hashes, about SAMPLE_WORDS of them: every task sends only its own share.
    share = -(-SAMPLE_WORDS * HASHES // max(SAMPLE_WORDS, sum(totals.values())))
    sample: dict[int, list[str]] = {}
    for r in words.select("word").where(F.pmod(F.xxhash64("word"), F.lit(HASHES)) < share).collect():
        sample.setdefault(len(r["word"]), []).append(r["word"])
    made, first = {}, 0
    for length, n in sorted(totals.items()):
        own = sample.get(length, [])
        cells: list[np.ndarray] = []
        if n <= cell_words or not own:
            root = Node(leaf=0)
            cells.append(np.zeros(0, np.int64))
        else:
            root = grow(vectors_of(codes_of(own, length)), cell_words * len(own) / n, cells)
        made[length] = (root, first)
        first += len(cells)
    return made


def route(words: DataFrame, trees: dict[int, tuple[Node, int]]) -> DataFrame:
    """cell, is_point, word and n: every word as a point of its cell and as a query of the cells in reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_length: dict[int, list[int]] = {}
            names = fast_list(batch.column(0))
            for i, word in enumerate(names):
                by_length.setdefault(len(word), []).append(i)
            cells, points, rows = [], [], []
            for length, own in by_length.items():
                own = np.array(own)
                vectors = vectors_of(codes_of([names[i] for i in own], length))
                for other, radius in ((length, 0), (length - 1, 1), (length, 2), (length + 1, 1)):
                    if other in trees:
                        root, first = trees[other]
                        for cell, hit in reach(root, vectors, radius):
                            cells.append(np.full(len(hit), first + cell))
                            points.append(np.full(len(hit), radius == 0))
                            rows.append(own[hit])
            if rows:
                rows = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cells)), pa.array(np.concatenate(points)), batch.column(0).take(rows), batch.column(1).take(rows)],
                    names=["cell", "is_point", "word", "n"],
                )

    return words.select("word", "n").mapInArrow(run, "cell bigint, is_point boolean, word string, n bigint")


def search(routed: DataFrame) -> DataFrame:
    """word, n_near, form_n and form of every query and cell with near words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, cell, held = None, None, ([], [])
        for batch in batches:
            asked: dict[tuple[int, int], list[str]] = {}
            out: list[tuple] = []

            def answer() -> None:
                nonlocal cell
                if asked and held[0]:
                    cell = cell or Cell(*held)
                    for part in asked.values():
                        out.extend(cell.answers(part))
                asked.clear()

            for number, is_point, word, n in zip(*map(fast_list, batch.columns)):
                if number != last:
                    answer()
                    last, cell, held = number, None, ([], [])
                if is_point:
                    held[0].append(word)
                    held[1].append(n)
                else:
                    asked.setdefault((number, len(word)), []).append(word)
            answer()
            if out:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["word", "n_near", "form_n", "form"])

    dealt = routed.repartition("cell").sortWithinPartitions("cell", F.col("is_point").desc(), "word")
    return dealt.mapInArrow(run, "word string, n_near bigint, form_n bigint, form string")


def roots_of(forms: DataFrame) -> DataFrame:
    """word and root of all words that have a form."""
    paths = shared(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = shared(paths.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        paths = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return paths


def group_variants(
    df: DataFrame, settings: Settings = Settings(), text: str = "text", doc_id: str = "doc_id", cell_words: int = CELL_WORDS
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    words = count_words(df, settings, text, doc_id)
    found = search(route(words, lay_out(words, cell_words)))
    best = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("order"), F.col("form").alias("form"))).alias("best")
    )
    rows = words.join(best, "word", "left")
    enough = -F.col("best.order") >= settings.ratio * F.col("n")
    rows = rows.select(
        "word", F.when(enough, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, -F.col("best.order")).alias("form_n"),
    )
    rows = shared(rows, "word-forms")
    rooted = rows.join(roots_of(rows.where("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
