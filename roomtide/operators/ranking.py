"""Ranks, row numbers and top-k that stay spread out when one group is huge.

A plain window puts a whole group, or a whole table, into one task. These forms cut
the order into ranges first, number the rows inside every range and add the count
of all earlier ranges. Only the counts, a row per range, go through one place. The number
of ranges follows the number of rows: beyond LIMITS of them, ranges are cut in two levels.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions.columns import as_column
from roomtide.session import cut_lineage

ROWS_PER_RANGE = 1_000_000
PIECES = 64
LIMITS = 1_000  # limits of one level of ranges
BROADCAST_RANGES = LIMITS * 1_024  # eight megabytes of limits


def value_ranges(df: DataFrame, name: str, ranges: int) -> tuple[list[float], dict[float, int]]:
    """Limits that cut a numeric column into about equal ranges, at most ``ranges`` of them.

    Also gives the values so frequent that they span several ranges, with that number.
    Such a value gets a range of its own.
    """
    shares = [i / ranges for i in range(1, ranges)]
    found = df.approxQuantile(name, shares, 1.0 / (4 * ranges)) if shares else []
    seen = Counter(found)
    least = max(2, min(16, ranges // 4))
    frequent = {value: times for value, times in seen.items() if times >= least}
    limits = set(found) | {math.nextafter(value, math.inf) for value in frequent}
    return sorted(limits), frequent


def ranges_for(rows: int, rows_per_range: int = ROWS_PER_RANGE) -> int:
    return max(1, math.ceil(rows / rows_per_range))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def with_value_ranges(df: DataFrame, name: str, ranges: int, out: str, limits_per_level: int = LIMITS) -> DataFrame:
    """Add the number of the range that the value of ``name`` falls into, about ``ranges`` of equal share, in order of the value.

    Up to ``limits_per_level`` ranges are cut by one list of limits. For more, every range is cut again by
    limits of its own, which one job finds for all ranges and which are searched by halving.
    """
    df = df.drop(out)
    if ranges <= 1:
        return df.withColumn(out, F.lit(0.0))
    if ranges <= limits_per_level:
        return with_range(df, name, value_ranges(df, name, ranges)[0], out)
    coarse, cuts, key = free_names(df, "_coarse", "_cuts", "_key")
    first = with_range(df, name, value_ranges(df, name, limits_per_level)[0], coarse)
    inner = math.ceil(ranges / limits_per_level)
    shares = F.array(*[F.lit(i / inner) for i in range(1, inner)]) if inner > 1 else F.array(F.lit(0.5))
    value = F.col(name).cast("double")
    fine = first.groupBy(F.col(coarse).alias(key)).agg(F.array_distinct(F.approx_percentile(value, shares, 4 * inner)).alias(cuts))
    fine = F.broadcast(fine) if ranges <= BROADCAST_RANGES else fine
    joined = first.join(fine, F.col(coarse).eqNullSafe(F.col(key)), "left")

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        right = F.get(F.col(cuts), middle) <= value
        narrowed = F.struct(F.when(right, middle + 1).otherwise(span["low"]).alias("low"), F.when(right, span["high"]).otherwise(middle).alias("high"))
        return F.when(span["low"] < span["high"], narrowed).otherwise(span)

    steps = F.array(*[F.lit(0)] * (inner.bit_length() + 1))
    whole = F.struct(F.lit(0).alias("low"), F.coalesce(F.size(cuts), F.lit(0)).alias("high"))
    place = F.coalesce(F.aggregate(steps, whole, halve)["low"], F.lit(0))
    return joined.withColumn(out, F.col(coarse) * (inner + 1) + place).drop(coarse, cuts, key)


def with_range(df: DataFrame, name: str, limits: Sequence[float], out: str) -> DataFrame:
    """Index of the range a value falls into; ranges are closed on the left."""
    df = df.drop(out)
    if not limits:
        return df.withColumn(out, F.lit(0.0))
    edges = [-math.inf, *limits, math.inf]
    return Bucketizer(splits=edges, inputCol=name, outputCol=out, handleInvalid="keep").transform(df)


def row_numbers(
    df: DataFrame,
    order_by: Column | str,
    tie_break: Column | str | None = None,
    out: str = "row_id",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Numbers 0..n-1 over a declared order, without a one-task window.

    ``tie_break`` makes the order total. Spark deals the rows to ranges of both keys, so a value of
    ``order_by`` that would fill a range alone is cut further along ``tie_break``.
    """
    first = as_column(order_by)
    second = as_column(tie_break) if tie_break is not None else F.lit(0)
    ranges = ranges_for(df.count(), rows_per_range)
    # The row stays in one struct, so that no helper meets a column of the caller.
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), first.alias("k1"), second.alias("k2"))
    if ranges == 1:
        numbered = keyed.withColumn("n", F.row_number().over(Window.orderBy("k1", "k2")) - 1)
    else:
        dealt = keyed.repartitionByRange(ranges, "k1", "k2").sortWithinPartitions("k1", "k2")
        # The lower 33 bits count the rows of a partition; written once, so that counts and rows belong together.
        placed = dealt.select("row", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("local"))
        placed = cut_lineage(placed, "ranges")
        before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
        starts = placed.groupBy("range").agg(F.count("*").alias("n_rows"))
        starts = starts.select("range", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("start"))
        numbered = placed.join(starts, "range").withColumn("n", F.col("start") + F.col("local"))
    columns = [F.col("row").getField(c).alias(c) for c in df.columns if c != out]
    return numbered.select(*columns, F.col("n").cast("long").alias(out))


def top_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    limit: int,
    unique: str,
    rank: str = "position",
    salts: int | None = None,
) -> DataFrame:
    """The first ``limit`` rows of every group with their rank, for a bounded ``limit``.

    Spark thins every task's rows to a rank limit below 1,000 before they are shuffled. For a
    larger limit groups are cut by a hash of ``unique`` and thinned piece by piece before the
    pieces meet. ``order`` must be total, so the result does not depend on it.
    """
    salts = (1 if limit < 1_000 else PIECES) if salts is None else salts
    if salts > 1:
        salt, place = free_names(df, "_salt", "_piece")
        salted = df.withColumn(salt, F.pmod(F.xxhash64(unique), F.lit(salts)))
        piece = Window.partitionBy(*keys, salt).orderBy(*order)
        df = salted.withColumn(place, F.row_number().over(piece)).filter(F.col(place) <= limit)
        df = df.drop(salt, place)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= limit)
