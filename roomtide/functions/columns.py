"""Null-safe predicates, dates, rounding and code clean-up."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide import schema

ColumnLike = str | Column


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def truthy(condition: Column) -> Column:
    """A predicate that counts an unknown outcome as false."""
    return F.coalesce(condition, F.lit(False))


def no_nan(value: ColumnLike, data_type: T.DataType | None = None) -> Column:
    """NaN becomes null for floating columns, so that NaN never beats an upper bound."""
    value = as_column(value)
    if data_type is not None and not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return value
    return F.when(~F.isnan(value), value)


def outside(value: ColumnLike, domain: Iterable) -> Column:
    """Present, but not one of ``domain``."""
    value = as_column(value)
    return truthy(value.isNotNull() & ~value.isin(list(domain)))


def null_texts_to_null(value: ColumnLike, texts: Sequence[str] = tuple(schema.NA_TEXTS)) -> Column:
    value = as_column(value)
    return F.when(~value.isin(list(texts)), value)


def to_integer(value: ColumnLike) -> Column:
    """Whole number from text such as ``7`` or ``7.0``; null when it is neither."""
    value = as_column(value)
    decimal = value.try_cast("decimal(20,4)")
    return F.coalesce(value.try_cast("int"), F.when(decimal == F.floor(decimal), decimal.try_cast("int")))


def month_number(name: ColumnLike) -> Column:
    """1 to 12 for an English month name, null for anything else."""
    months = F.array(*[F.lit(m) for m in schema.MONTHS])
    position = F.array_position(months, as_column(name))
    return F.when(position > 0, position.cast("int"))


def date_text(year: ColumnLike, month: ColumnLike, day: ColumnLike) -> Column:
    return F.concat_ws(
        "-", as_column(year).cast("string"), month_number(month).cast("string"), as_column(day).cast("string")
    )


def arrival_date(year: ColumnLike, month: ColumnLike, day: ColumnLike, strict: bool = True) -> Column:
    """Date from year, English month name and day.

    The strict form raises on an impossible date, the other gives null.
    """
    if strict:
        number = month_number(month)
        unknown = as_column(month).isNotNull() & number.isNull()
        message = F.concat(F.lit("not a month name: "), as_column(month))
        checked = F.when(unknown, F.raise_error(message).cast("int")).otherwise(number)
        return F.make_date(as_column(year), checked, as_column(day))
    return F.try_to_date(date_text(year, month, day), "y-M-d")


def length_of_stay(weekend: ColumnLike | None, week: ColumnLike | None) -> Column:
    """Nights of both kinds with missing as 0, and at least one night."""
    parts = [F.coalesce(as_column(c), F.lit(0)) for c in (weekend, week) if c is not None]
    if not parts:
        return F.lit(1)
    total = parts[0] if len(parts) == 1 else parts[0] + parts[1]
    return F.greatest(F.lit(1), total.cast("int"))


def half_even(value: ColumnLike) -> Column:
    """Round to a whole number, ties to the even neighbour."""
    return F.bround(as_column(value), 0).cast("int")


def clipped(value: ColumnLike, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), as_column(value)))


def month_key(day: ColumnLike) -> Column:
    return F.date_format(as_column(day), "yyyy-MM")


def missing_flag(value: ColumnLike) -> Column:
    return as_column(value).isNull().cast("int")


def code_or_unknown(value: ColumnLike) -> Column:
    """Numeric code as text without a decimal point; ``Unknown`` when missing."""
    return F.coalesce(as_column(value).cast("int").cast("string"), F.lit("Unknown"))


def week_of_path(path: ColumnLike) -> Column:
    """Week number in a file name such as ``week_07.csv``; 0 when there is none."""
    digits = F.regexp_extract(as_column(path), r"week_(\d+)[^/]*$", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))

