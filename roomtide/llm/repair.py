"""Repair of conversation structure by a dynamic program over persistent audit trails.

A repaired conversation is empty, or an optional system message and then turns of user and assistant.
Rows are kept, given another role, deleted, or empty messages are inserted, each at a cost. The program
walks the rows once; a cell (row, place in the pattern) holds the least cost and the edits so far as a
linked node, so trails share their prefixes. A node knows its depth, a rolling hash of its letters and
its ancestors at powers of two. Of trails of equal cost the ASCII-least wins: both are lifted to one
depth and the longest common prefix is found by lifting while hashes differ; equal hashes of different
nodes are verified letter by letter.

Damage, faults and repeats are found by Spark: repeated messages are counted by digest, so one message
that fills a conversation is no hot group, and rows are then dealt by conversation in order. A task
streams them: whenever all live trails share an ancestor, the edits up to it are settled, go into the
result and the checksum, and their rows are forgotten. What a task holds is the unsettled end of one
conversation. The checksum of a whole conversation is sequential by its nature.

Cases: a null role or text is one space, as a null id or turn is in the damage key; null turns come
first; rows of one turn are ordered by role and text; a null conversation id is a conversation; equal
rows are duplicates of each other; a conversation without rows after damage has zeros and an empty
audit; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide.llm.common import shared

WHITE = " \t\n\x0b\x0c\r"
PRIME, FACTOR = (1 << 61) - 1, 1_000_003
SETTLE_EVERY = 512

# The pattern as states: 0 nothing yet, 1 after the system message, 2 after a user, 3 after an assistant.
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
NEXT = (2, 2, 3, 2)  # where a user or assistant message leads
ROLE = ("user", "user", "assistant", "user")  # the message that the state waits for
GOOD_PAIRS = frozenset(("su", "ua", "au"))


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


# --- trails ----------------------------------------------------------------------


class Trail:
    """The end of a list of edits; earlier edits are its ancestors."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Trail | None, letter: str):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * FACTOR + ord(letter)) % PRIME
        up, k = [parent], 0
        while len(up[k].up) > k:
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    @property
    def parent(self) -> Trail | None:
        return self.up[0] if self.up else None


def lifted(trail: Trail, depth: int) -> Trail:
    """The ancestor with that depth."""
    while trail.depth > depth:
        trail = trail.up[(trail.depth - depth).bit_length() - 1]
    return trail


def same(a: Trail, b: Trail) -> bool:
    """Whether two trails of one depth have the same letters; equal hashes are verified."""
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.parent, b.parent
        if a is None or b is None:
            return a is b
    return True


def less(a: Trail, b: Trail) -> bool:
    """Whether the letters of ``a`` come first in ASCII order."""
    depth = min(a.depth, b.depth)
    x, y = lifted(a, depth), lifted(b, depth)
    if same(x, y):
        return a.depth < b.depth
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and k < len(y.up) and not same(x.up[k], y.up[k]):
            x, y = x.up[k], y.up[k]
    return x.letter < y.letter


def common_ancestor(trails: list[Trail]) -> Trail:
    first = trails[0]
    for other in trails[1:]:
        depth = min(first.depth, other.depth)
        x, y = lifted(first, depth), lifted(other, depth)
        if x is not y:
            for k in range(len(x.up) - 1, -1, -1):
                if k < len(x.up) and k < len(y.up) and x.up[k] is not y.up[k]:
                    x, y = x.up[k], y.up[k]
            x = x.parent
        first = x
    return first


def letters_after(trail: Trail, ancestor: Trail) -> str:
    found = []
    while trail is not ancestor:
        found.append(trail.letter)
        trail = trail.parent
    return "".join(reversed(found))


# --- one conversation -------------------------------------------------------------


class Conversation:
    """Takes the rows of a conversation in order; ``result`` closes it."""

    def __init__(self, costs: Costs, settle_every: int = SETTLE_EVERY):
        self.costs, self.settle_every = costs, settle_every
        self.low = self.high = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.before: tuple | None = None
        self.root = Trail(None, "")
        self.cells: list[tuple[int, Trail] | None] = [(0, self.root), None, None, None]
        self.pending: deque[tuple[str, str]] = deque()
        self.state, self.audit, self.sum, self.written = 0, [], hashlib.sha256(), False

    def offer(self, cells: list, state: int, cost: int, parent: Trail, letter: str) -> bool:
        """Put a longer trail into a cell if it is cheaper, or as cheap and ASCII-less."""
        held = cells[state]
        if held is not None and cost > held[0]:
            return False
        trail = Trail(parent, letter)
        if held is not None and cost == held[0] and not less(trail, held[1]):
            return False
        cells[state] = (cost, trail)
        return True

    def insert(self) -> None:
        """Let every cell be followed by inserted messages."""
        moved = [s for s in range(4) if self.cells[s] is not None]
        while moved:
            state = moved.pop(0)
            cost, trail = self.cells[state]
            if self.offer(self.cells, NEXT[state], cost + self.costs.insert, trail, "I"):
                moved.append(NEXT[state])

    def add(self, turn: int | None, role: str, text: str, repeats: bool) -> None:
        """The next row; ``repeats`` tells that an earlier turn has the same message."""
        self.rows += 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        body = text.rstrip(WHITE)
        fault = ""
        if not body:
            fault, self.blank = "blank", self.blank + 1
        elif repeats or self.before == (turn, role, text):
            fault, self.duplicate = "duplicate", self.duplicate + 1
        elif body[-1] not in ".!?":
            fault, self.truncated = "truncated", self.truncated + 1
        if self.before is not None:
            self.illegal += self.before[1][:1] + role[:1] not in GOOD_PAIRS
        self.before = (turn, role, text)

        self.insert()
        more = self.costs.truncated if fault == "truncated" else 0
        after: list[tuple[int, Trail] | None] = [None] * 4
        for state, cell in enumerate(self.cells):
            if cell is None:
                continue
            cost, trail = cell
            self.offer(after, state, cost + self.costs.delete, trail, "D")
            if fault not in ("blank", "duplicate"):
                kept = KEEPS.get((state, role[:1]))
                if kept is not None:
                    self.offer(after, kept, cost + more, trail, "K")
                self.offer(after, NEXT[state], cost + more + self.costs.rerole, trail, "R")
        self.cells = after
        self.pending.append((role, text))
        if len(self.pending) >= self.settle_every and self.rows % self.settle_every == 0:
            self.settle()

    def settle(self) -> None:
        """Write the edits that all live trails share and hang the rest on a fresh root."""
        live = [c[1] for c in self.cells if c is not None]
        ancestor = common_ancestor(live)
        if ancestor.depth == self.root.depth:
            return
        self.write(letters_after(ancestor, self.root))
        self.root = Trail(None, "")
        self.root.depth, self.root.hash = ancestor.depth, ancestor.hash
        made = {id(ancestor): self.root}
        cells: list[tuple[int, Trail] | None] = []
        for cell in self.cells:
            if cell is None:
                cells.append(None)
                continue
            path, trail = [], cell[1]
            while id(trail) not in made:
                path.append(trail)
                trail = trail.parent
            copy = made[id(trail)]
            for old in reversed(path):
                copy = made[id(old)] = Trail(copy, old.letter)
            cells.append((cell[0], copy))
        self.cells = cells

    def write(self, letters: str) -> None:
        self.audit.append(letters)
        for letter in letters:
            if letter == "I":
                line = f"{ROLE[self.state]}:"
                self.state = NEXT[self.state]
            else:
                role, text = self.pending.popleft()
                if letter == "D":
                    continue
                if letter == "R":
                    role, self.state = ROLE[self.state], NEXT[self.state]
                else:
                    self.state = KEEPS[(self.state, role[:1])]
                line = f"{role}:{text}"
            self.sum.update(("\n" if self.written else "").encode() + line.encode("utf-8", "replace"))
            self.written = True

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit and the checksum."""
        self.insert()
        ends = [c for c in (self.cells[0], self.cells[3]) if c is not None]
        best = ends[0]
        for other in ends[1:]:
            if other[0] < best[0] or other[0] == best[0] and less(other[1], best[1]):
                best = other
        self.write(letters_after(best[1], self.root))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, best[0], "".join(self.audit), self.sum.hexdigest()


# --- tables ----------------------------------------------------------------------


def damage(df: DataFrame) -> DataFrame:
    """The rows of (conv_id, turn, role, text) after damage; those that it drops stay marked, without text."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    text = F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), F.array_repeat(F.lit(0), times).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", "dropped", F.explode("times").alias("time")).drop("time")


def mark_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with ``repeats``: whether an earlier turn of the conversation has the same role and text."""
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    marked = rows.withColumn("digest", digest)
    often = marked.where("not dropped").groupBy("conv_id", "digest").agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first")
    )
    often = often.where("n > 1").select(F.col("conv_id").alias("r_conv"), F.col("digest").alias("r_digest"), F.col("first.turn").alias("r_turn"))
    joined = marked.join(often, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("digest") == F.col("r_digest")), "left")
    repeats = F.col("r_digest").isNotNull() & ~F.col("turn").eqNullSafe(F.col("r_turn"))
    return joined.select("conv_id", "turn", "role", "text", "dropped", repeats.alias("repeats"))


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def repair_rows(rows: DataFrame, costs: Costs = Costs(), settle_every: int = SETTLE_EVERY) -> DataFrame:
    """A row per conversation of (conv_id, turn, role, text, dropped, repeats)."""
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T._parse_datatype_string(RESULT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        talk, last, started, out = None, None, False, []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        for batch in batches:
            for conv, turn, role, text, dropped, repeats in zip(*(c.to_pylist() for c in batch.columns)):
                if not started or conv != last:
                    if started:
                        out.append((last, *talk.result()))
                    talk, last, started = Conversation(costs, settle_every), conv, True
                if not dropped:
                    talk.add(turn, role, text, repeats)
            if out:
                yield made()
                out = []
        if started:
            out.append((last, *talk.result()))
            yield made()

    dealt = rows.select("conv_id", "turn", "role", "text", "dropped", "repeats").repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def damage_and_repair(df: DataFrame, costs: Costs = Costs(), settle_every: int = SETTLE_EVERY) -> DataFrame:
    """conv_id, the counts of faults, the least cost, its audit and the checksum of the repaired conversation."""
    rows = shared(damage(df), "damaged")
    return repair_rows(mark_repeats(rows), costs, settle_every)
