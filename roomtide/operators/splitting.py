"""Chronological split, its integrity checks, the manifest, weekly slices and retraining windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide import schema
from roomtide.sources.hashes import fingerprint_columns

SPLIT_MONTHS = (12, 6, 3)
WINDOW_MONTHS = {"train": (21, 9), "validation": (9, 3), "test": (3, 0)}


class SplitError(ValueError):
    """A split is incomplete, empty, out of order or overlaps another."""


def add_months(day: date, months: int) -> date:
    """Same day of a later or earlier month, moved back to the month's last day where needed."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    after = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last = (after - date(year, month + 1, 1)).days
    return date(year, month + 1, min(day.day, last))


def split_bounds(df: DataFrame, day: str = "arrival_date", months: Sequence[int] = SPLIT_MONTHS) -> list[date]:
    """First days of the second and every later split, counted from the first month of the table."""
    if day not in df.columns:
        raise SplitError(f"Column '{day}' not found in dataset.")
    first = df.agg(F.min(F.col(day).cast("date"))).first()[0]
    if first is None:
        raise SplitError("no dates to split on")
    bounds, month = [], first.replace(day=1)
    for length in months:
        month = add_months(month, length)
        bounds.append(month)
    return bounds


def split_of(day: Column, bounds: Sequence[date], names: Sequence[str] = tuple(schema.SPLITS)) -> Column:
    """Name of the half-open period a day falls into; null for a missing day."""
    chosen = F.when(day < F.lit(bounds[0]), names[0])
    for name, upper in zip(names[1:-1], bounds[1:]):
        chosen = chosen.when(day < F.lit(upper), name)
    return chosen.when(day >= F.lit(bounds[-1]), names[-1])


def temporal_split(df: DataFrame, day: str = "arrival_date", months: Sequence[int] = SPLIT_MONTHS) -> DataFrame:
    """The table with a ``split`` column. The limits are literals, so later filters reach the scan."""
    bounds = split_bounds(df, day, months)
    return df.withColumn("split", split_of(F.col(day).cast("date"), bounds))


def split_stats(df: DataFrame, day: str = "arrival_date", label: str = schema.TARGET) -> DataFrame:
    """Rows, share of all rows in percent, first and last day and label rate of every split."""
    per_split = df.filter(F.col("split").isNotNull()).groupBy("split")
    stats = per_split.agg(
        F.count("*").alias("n_rows"),
        F.min(F.col(day).cast("date")).alias("start_date"),
        F.max(F.col(day).cast("date")).alias("end_date"),
        F.avg(label).alias("cancellation_rate"),
    )
    # four rows at most: the names of the splits
    total = F.sum("n_rows").over(Window.partitionBy())
    return stats.select(
        "split", "n_rows", (F.col("n_rows") * 100 / total).alias("percent"), "start_date", "end_date",
        "cancellation_rate",
    )


def manifest(
    df: DataFrame,
    day: str = "arrival_date",
    label: str = schema.TARGET,
    columns: Sequence[str] | None = None,
    months: Sequence[int] = SPLIT_MONTHS,
) -> DataFrame:
    """One nested document: method, months and per split the statistics and a fingerprint.

    The fingerprint stands in for a file hash: part files differ between runs, rows do not.
    """
    columns = list(columns or [c for c in df.columns if c != "split"])
    per_split = df.filter(F.col("split").isNotNull()).groupBy("split").agg(
        F.min(F.col(day).cast("date")).alias("start_date"),
        F.max(F.col(day).cast("date")).alias("end_date"),
        F.avg(label).alias("cancellation_rate"),
        *fingerprint_columns(columns),
    )
    entry = F.struct(
        F.col("n_rows").alias("rows"),
        "start_date",
        "end_date",
        "cancellation_rate",
        F.concat_ws(":", F.col("hash_sum").cast("string"), F.hex("hash_xor")).alias("fingerprint"),
    )
    splits = F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", entry))))
    return per_split.agg(
        F.lit(day).alias("split_method"),
        F.lit(months[0]).alias("train_months"),
        F.lit(months[1]).alias("validation_months"),
        F.lit(months[2]).alias("test_months"),
        F.lit("remaining_period").alias("production"),
        splits.alias("splits"),
    )


def split_order(df: DataFrame, day: str = "arrival_date", names: Sequence[str] = tuple(schema.SPLITS)) -> DataFrame:
    """Per neighbouring pair of splits: last day, next first day and whether they are in order.

    An empty split has no days, and its pairs are not in order.
    """
    ends = []
    for name in names:
        at = F.when(F.col("split") == name, F.col(day).cast("date"))
        ends += [F.min(at).alias(f"min_{name}"), F.max(at).alias(f"max_{name}")]
    lines = [
        F.struct(
            F.lit(a).alias("earlier"),
            F.lit(b).alias("later"),
            F.col(f"max_{a}").alias("earlier_end"),
            F.col(f"min_{b}").alias("later_start"),
            F.coalesce(F.col(f"max_{a}") < F.col(f"min_{b}"), F.lit(False)).alias("in_order"),
        )
        for a, b in zip(names, names[1:])
    ]
    return df.agg(*ends).select(F.inline(F.array(*lines)))


def split_overlap(
    df: DataFrame, columns: Sequence[str] | None = None, names: Sequence[str] = tuple(schema.SPLITS)
) -> DataFrame:
    """Number of distinct rows that two splits share, for every pair. One grouped pass for all pairs.

    Rows are compared on the columns themselves. Each distinct row keeps only a bit per
    split, combined map-side, so a group of copies of any size stays small.
    """
    columns = list(columns or [c for c in df.columns if c != "split"])
    bit = F.lit(0)
    for index, name in enumerate(names):
        bit = F.when(F.col("split") == name, 1 << index).otherwise(bit)
    seen = df.groupBy(*columns).agg(F.bit_or(bit).alias("_splits"))
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    counts = seen.agg(
        *[
            F.count_if(F.col("_splits").bitwiseAND((1 << i) | (1 << j)) == ((1 << i) | (1 << j))).alias(f"n_{i}_{j}")
            for i, j in pairs
        ]
    )
    lines = [
        F.struct(F.lit(names[i]).alias("split_a"), F.lit(names[j]).alias("split_b"), F.col(f"n_{i}_{j}").alias("n_shared"))
        for i, j in pairs
    ]
    return counts.select(F.inline(F.array(*lines)))


def completeness(original: DataFrame, split: DataFrame, names: Sequence[str] = tuple(schema.SPLITS)) -> DataFrame:
    """Row counts before and after the split. Rows without a split are not counted as kept."""
    kept = F.when(F.col("split").isin(list(names)), 1).otherwise(0)
    marks = original.select(F.lit(1).alias("o"), F.lit(0).alias("s")).unionAll(
        split.select(F.lit(0).alias("o"), kept.alias("s"))
    )
    both = marks.agg(F.sum("o").alias("n_original"), F.sum("s").alias("n_split"))
    return both.withColumn("complete", F.col("n_original") == F.col("n_split"))


def check_split(original: DataFrame, split: DataFrame, day: str = "arrival_date", columns: Sequence[str] | None = None) -> None:
    """Raise unless the split is complete, free of shared rows and in order."""
    counts = completeness(original, split).first()
    if not counts.complete:
        raise SplitError(f"Split does not contain all original rows: {counts.n_split} of {counts.n_original}.")
    shared = split_overlap(split, columns).filter(F.col("n_shared") > 0).first()
    if shared is not None:
        raise SplitError(f"Data overlap detected: {shared.split_a} and {shared.split_b} share {shared.n_shared} rows.")
    bad = split_order(split, day).filter(~F.col("in_order")).first()
    if bad is not None:
        raise SplitError(f"{bad.earlier} must end before {bad.later} starts ({bad.earlier_end}, {bad.later_start}).")


def lost_rows(original: DataFrame, split: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (with multiplicity) of the original the split lacks: a stricter completeness check."""
    return original.select(*columns).exceptAll(split.filter(F.col("split").isNotNull()).select(*columns))


def with_week(df: DataFrame, day: str = "arrival_date", out: str = "week") -> DataFrame:
    """Week number 1, 2, ... counted from the earliest day of the table."""
    first = df.agg(F.min(F.col(day).cast("date"))).first()[0]
    week = F.floor(F.datediff(F.col(day).cast("date"), F.lit(first)) / 7).cast("int") + 1
    return df.withColumn(out, week)


def retrain_window(
    df: DataFrame, cutoff: date, day: str = "arrival_date", check: bool = True
) -> DataFrame:
    """Rows of the 21 months before ``cutoff`` with their ``split``; raises when a part is empty.

    The bounds are literals on both sides, so they reach the scan as pushed filters.
    """
    value = F.col(day).cast("date")
    chosen = F.lit(None).cast("string")
    for name, (start, stop) in WINDOW_MONTHS.items():
        inside = (value >= F.lit(add_months(cutoff, -start))) & (value < F.lit(add_months(cutoff, -stop)))
        chosen = F.when(inside, name).otherwise(chosen)
    oldest = max(start for start, _ in WINDOW_MONTHS.values())
    kept = df.filter((value >= F.lit(add_months(cutoff, -oldest))) & (value < F.lit(cutoff)))
    kept = kept.withColumn("split", chosen)
    if check:
        found = kept.agg(*[F.count_if(F.col("split") == name).alias(name) for name in WINDOW_MONTHS]).first()
        empty = [name for name in WINDOW_MONTHS if not found[name]]
        if empty:
            raise SplitError(f"{', '.join(empty)} has no rows before {cutoff}: the cutoff is too early")
    return kept
