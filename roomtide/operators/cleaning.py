"""Duplicate flags, the cleaning filter with its removal gate, and derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide import schema
from roomtide.functions.columns import arrival_date, truthy
from roomtide.operators.ranking import free_names, row_numbers
from roomtide.operators.validation import guest_total

MAX_REMOVAL_PERCENT = 1.0


class RemovalGateError(ValueError):
    """Cleaning would remove more of the table than allowed."""


def flag_duplicates(df: DataFrame, columns: Sequence[str] | None = None, out: str = "is_duplicate") -> DataFrame:
    """Mark every copy of rows that agree on ``columns`` (nulls agree with nulls).

    Only 8-byte row hashes are counted first, with map-side combining, so a group of
    copies of any size costs one row per task. Rows with a repeated hash are then
    compared on the columns themselves, which removes chance hash matches. The join
    back keeps the big side as it is; adaptive execution splits it at a hot key.
    """
    columns = list(columns or [c for c in schema.RAW_COLUMNS if c in df.columns])
    # a struct of the columns compares null with null as equal
    row_hash, row = F.xxhash64(*columns), F.struct(*columns)
    repeated = df.groupBy(row_hash.alias("_rh")).count().filter(F.col("count") > 1).select("_rh")
    suspects = df.select(row_hash.alias("_h"), row.alias("_row")).join(repeated, F.col("_h") == F.col("_rh"), "left_semi")
    # grouping by the row alone lets the join above be split at a hot hash
    copies = suspects.groupBy("_row").count().filter(F.col("count") > 1)
    copies = copies.select("_row", F.xxhash64(*[F.col("_row")[c] for c in columns]).alias("_h"))
    # the keys are expressions of the row, so the shuffle carries each row once
    joined = df.join(copies, (row_hash == F.col("_h")) & (row == F.col("_row")), "left")
    return joined.select(*df.columns, F.col("_h").isNotNull().alias(out))


def duplicate_totals(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in groups of copies, and the copies beyond the first of each group."""
    columns = list(columns or [c for c in schema.RAW_COLUMNS if c in df.columns])
    groups = df.groupBy(*columns).agg(F.count("*").alias("n"))
    members = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return groups.agg(members.alias("all_members"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_copies"))


def unwanted(df: DataFrame, price: str = "adr", guests: Sequence[str] = tuple(schema.GUEST_COLUMNS)) -> Column:
    """Rows cleaning removes: a negative price or no guests. A missing price is kept."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return truthy(F.col(price) < 0) | (guest_total(types, guests) == 0)


def clean_filter(df: DataFrame, price: str = "adr", guests: Sequence[str] = tuple(schema.GUEST_COLUMNS)) -> DataFrame:
    return df.filter(~unwanted(df, price, guests))


def removal_rate(
    df: DataFrame, price: str = "adr", guests: Sequence[str] = tuple(schema.GUEST_COLUMNS)
) -> DataFrame:
    """One row: rows, rows to remove by reason and the percentage (null for an empty table)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    removed = F.count_if(unwanted(df, price, guests))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(truthy(F.col(price) < 0)).alias("n_negative_price"),
        F.count_if(guest_total(types, guests) == 0).alias("n_zero_guests"),
        removed.alias("n_removed"),
        F.try_divide(removed, F.count("*")).alias("_share"),
    ).select("n_rows", "n_negative_price", "n_zero_guests", "n_removed", (F.col("_share") * 100).alias("percent"))


def check_removal(df: DataFrame, max_percent: float = MAX_REMOVAL_PERCENT) -> None:
    """Raise when cleaning would remove strictly more than ``max_percent`` of the rows."""
    row = removal_rate(df).first()
    if row.n_rows == 0:
        raise RemovalGateError("nothing to clean: the table is empty")
    if row.percent > max_percent:
        raise RemovalGateError(f"Cleaning would remove {row.percent:.2f}% of rows, limit is {max_percent}%")


def with_dates(df: DataFrame) -> DataFrame:
    """Arrival date from its three parts (raises on an impossible one) and the day of booking."""
    arrived = arrival_date("arrival_date_year", "arrival_date_month", "arrival_date_day_of_month")
    dated = df.withColumn("arrival_date", arrived)
    return dated.withColumn("booking_date", F.date_sub("arrival_date", F.col("lead_time")))


def clean(
    df: DataFrame,
    order_by: Column | str,
    tie_break: Column | str | None = None,
    max_percent: float = MAX_REMOVAL_PERCENT,
) -> DataFrame:
    """Flag duplicates, remove bad rows behind the gate, number the rest and derive the dates.

    Input order is no property of a Spark table, so the order of ``row_id`` is declared.
    """
    check_removal(df, max_percent)
    kept = clean_filter(flag_duplicates(df))
    numbered = row_numbers(with_dates(kept), order_by, tie_break, out="row_id")
    raw = [c for c in df.columns if c in schema.RAW_COLUMNS]
    return numbered.select("row_id", *raw, "is_duplicate", "arrival_date", "booking_date")


def break_cells(df: DataFrame, cells: Sequence[tuple[int, str, object]], row_id: str = "row_id") -> DataFrame:
    """Overwrite single cells by row number: builds a table the validation gate must stop."""
    by_column: dict[str, Column] = {}
    for row, name, value in cells:
        current = by_column.get(name, F.col(name))
        replaced = F.lit(value).cast(df.schema[name].dataType)
        by_column[name] = F.when(F.col(row_id) == row, replaced).otherwise(current)
    return df.withColumns(by_column)


# The five bad cells of the demonstration table.
BAD_CELLS = [
    (0, "is_canceled", 2),
    (1, "lead_time", -10),
    (2, "arrival_date_month", "Januar"),
    (3, "adr", -50.0),
    (4, "is_repeated_guest", 3),
]


def flip_first_labels(
    df: DataFrame, order_by: str, label: str = schema.TARGET, share: float = 0.40
) -> DataFrame:
    """Turn the label around in the first ``share`` of the rows by a declared order."""
    (position,) = free_names(df, "_position")
    numbered = row_numbers(df, order_by, out=position)
    n_flip = int(df.count() * share)
    flipped = F.when(F.col(position) < n_flip, 1 - F.col(label)).otherwise(F.col(label))
    return numbered.withColumn(label, flipped).drop(position)
