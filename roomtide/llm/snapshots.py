"""Chat formatting with cumulative-snapshot collapse; DataFrame functions only.

A chat log often holds the same conversation several times, each time some turns longer.
Every turn is hashed together with its place in the conversation, and a running sum over the
turns gives the hash of each prefix: the sum rolls, since adding a turn adds one term, and the
place in each term keeps the order. A conversation whose whole hash is a proper prefix hash
of another is a snapshot and is removed by an anti-join; of equal conversations the smallest
id stays. What is left is rendered.

Hashes move, texts do not: prefix hashes are made distinct before they meet, so a first turn
that a third of all conversations share is one row. Only the turns of conversations that stay
are shuffled with their texts. One conversation becomes one output row, so its turns meet in
one task; that is the limit of a row, not of the number of conversations.

Cases: turns are ordered by turn, then role, then the md5 of the text (nulls first; null role or
text equals empty); a turn row that repeats exactly within a conversation counts once; a null
conversation id is an id like any other; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The markers of the rendered form.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def distinct_turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, role, text without nulls in role and text, each turn row once."""
    return df.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def hash_pair(*columns: str | Column) -> Column:
    """128 bits as two longs."""
    return F.struct(F.xxhash64(F.lit(0), *columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, place, n_turns and the hash of the first ``place`` turns, for each turn row once; texts do not move."""
    rows = turns.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest")).distinct()
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "digest")
    whole = Window.partitionBy("conv_id")
    placed = rows.withColumn("place", F.row_number().over(order))
    term = placed.withColumn("t", hash_pair("place", "role", "digest"))
    low, high = F.lit(0xFFFFFFFF), 32
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    # Sums of 32-bit halves cannot overflow a long.
    halves = [
        F.sum(half).over(running).alias(name)
        for name, half in (
            ("h1", F.col("t.a").bitwiseAND(low)),
            ("h2", F.shiftrightunsigned("t.a", high)),
            ("h3", F.col("t.b").bitwiseAND(low)),
            ("h4", F.shiftrightunsigned("t.b", high)),
        )
    ]
    return term.select("conv_id", "place", F.count("*").over(whole).alias("n_turns"), *halves)


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of the conversations that no other one extends, one of each group of equals."""
    key = ["place", "h1", "h2", "h3", "h4"]
    hashes = prefix_hashes(turns)
    heads = hashes.where("place = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = hashes.where("place < n_turns").select(*key).distinct()
    return heads.join(inner, key, "left_anti").select("conv_id", F.col("place").cast("long").alias("n_turns"), "n_copies")


def render(role: str | Column, text: str | Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE + "\n"))


def collapse_and_render(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, n_turns, n_copies and the rendered text of every maximal conversation."""
    turns = distinct_turns(df, conv_id, turn, role, text)
    kept = maximal(turns).withColumnRenamed("conv_id", "kept_id")
    rows = turns.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    entry = F.struct("turn", "role", F.md5(F.col("text").cast("binary")), "text")
    listed = rows.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_set(entry)).alias("turns"))
    lines = F.transform("turns", lambda t: render(t["role"], t["text"]))
    return listed.select("conv_id", "n_turns", "n_copies", F.array_join(lines, "").alias("text"))
