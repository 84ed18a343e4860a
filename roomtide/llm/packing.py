"""Packing into optimal length buckets.

Sequences are cut at ``max_length`` tokens (every piece is kept), so the histogram of lengths,
counted over all rows, has at most ``max_length`` entries and may go to the driver whatever
the number of rows. A dynamic program over it chooses the bucket boundaries with the least
padding: best[k][j] = min over i of best[k-1][i] + cost(i, j), where cost is the padding of
lengths i+1..j padded to the j-th. Ties go to the lower boundary. Inside a bucket sequences
are ordered by the md5 of their key, and every floor(budget / boundary) of them form a batch.

The rank inside a bucket is exact without one task per bucket: rows are dealt to blocks that
are ranges of the md5, so the rank is the rows of earlier blocks plus the rank in the block.
The number of blocks follows the number of rows and does not change the result.

Cases: a null or wordless text has length 1 (the end token); repeated rows are sequences of
their own and tie in order, so they are interchangeable; a null id is hashed as empty text;
an empty table gives an empty result. Texts do not move, only ids and lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide.llm.common import shared

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    max_length: int = 2048
    buckets: int = 8
    budget: int = 16384  # padded tokens of a batch; at least max_length
    block_rows: int = 50_000


def word_length(text: str | Column) -> Column:
    """Words and an end token; a null text has the end token only."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long") + 1


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of the at most ``buckets`` buckets with the least padding."""
    m = len(lengths)
    if m == 0:
        return []
    rows = np.concatenate(([0], np.cumsum(counts)))
    tokens = np.concatenate(([0], np.cumsum(counts * lengths)))
    best = lengths * rows[1:] - tokens[1:]  # one bucket for the first j lengths
    best = np.concatenate(([0], best))
    choice = [np.zeros(m + 1, np.int64)]
    for _ in range(1, min(buckets, m)):
        now, cut = best.copy(), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            cost = best[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            cut[j] = np.argmin(cost)
            now[j] = cost[cut[j]]
        best = now
        choice.append(cut)
    ends, j = [], m
    for cut in reversed(choice):
        if j > 0:
            ends.append(int(lengths[j - 1]))
            j = int(cut[j])
    return ends[::-1]


def pieces(df: DataFrame, doc_id: str, length: Column, max_length: int) -> DataFrame:
    """doc_id, piece (from 0) and length of every sequence of at most ``max_length`` tokens."""
    rows = df.select(F.col(doc_id).alias("doc_id"), length.alias("n"))
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / max_length)))
    return rows.select("doc_id", "n", cut.alias("piece")).select(
        "doc_id", "piece", F.least(F.lit(max_length).cast("long"), F.col("n") - F.col("piece") * max_length).alias("length")
    )


def pack(df: DataFrame, doc_id: str = "doc_id", length: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """doc_id, piece, length, padded (the bucket), batch (in the bucket) and slot (in the batch)."""
    length = word_length("text") if length is None else length
    rows = shared(pieces(df, doc_id, length, settings.max_length), "sequences")
    histogram = sorted((r["length"], r["n"]) for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect())
    lengths = np.array([x for x, _ in histogram], np.int64)
    counts = np.array([n for _, n in histogram], np.int64)
    ends = boundaries(lengths, counts, settings.buckets)
    blocks = max(1, int(counts.sum()) // settings.block_rows)
    if not ends:
        schema = rows.schema.add("padded", T.LongType()).add("batch", T.LongType()).add("slot", T.LongType())
        return rows.sparkSession.createDataFrame([], schema)
    padded = F.lit(ends[-1]).cast("long")
    for end in reversed(ends[:-1]):
        padded = F.when(F.col("length") <= end, F.lit(end).cast("long")).otherwise(padded)
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("piece").cast("string")).cast("binary"))
    block = F.floor(F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long") * blocks / (1 << 32))
    dealt = rows.withColumn("padded", padded).withColumn("order_key", key).withColumn("block", block).repartition("padded", "block")
    sizes = dealt.groupBy("padded", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("padded").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("padded", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("padded", "block").orderBy("order_key", "doc_id", "piece")
    ranked = dealt.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["padded", "block"])
    rank, room = F.col("start") + F.col("rank"), F.floor(F.lit(settings.budget) / F.col("padded"))
    return ranked.select(
        "doc_id", "piece", "length", "padded", F.floor(rank / room).alias("batch"), F.pmod(rank, room).cast("long").alias("slot")
    )
