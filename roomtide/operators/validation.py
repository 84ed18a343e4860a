"""Validation of a bookings table: every rule and column in one pass over the data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide import schema
from roomtide.functions.columns import arrival_date, month_number, no_nan, outside, truthy

CORRUPT = schema.CORRUPT
REPORT_SCHEMA = "position int, rule string, column string, n_bad bigint, message string"


class ValidationFailed(ValueError):
    """The table broke at least one rule; ``errors`` holds the messages in rule order."""

    def __init__(self, errors: Sequence[str]):
        super().__init__("VALIDATION FAILED\n" + "\n".join(errors))
        self.errors = list(errors)


@dataclass(frozen=True)
class Rule:
    """A condition that marks a bad row. ``{n}`` in the text stands for the number of bad rows."""

    name: str
    column: str
    bad: Column
    text: str

    def message(self, n: Column) -> Column:
        before, after = self.text.split("{n}")
        return F.concat(F.lit(before), n.cast("string"), F.lit(after))


@dataclass(frozen=True)
class TypedColumn:
    """Declared column of a typed schema: kind is ``str``, ``int`` or ``float``."""

    kind: str
    allowed: Sequence | None = None
    at_least: float | None = None


# The declared schema of the small typed check.
TYPED_BOOKING = {
    "hotel": TypedColumn("str", allowed=schema.DOMAINS["hotel"]),
    "is_canceled": TypedColumn("int", allowed=[0, 1]),
    "arrival_date_year": TypedColumn("int", allowed=schema.YEARS),
    "arrival_date_month": TypedColumn("str", allowed=schema.MONTHS),
    "lead_time": TypedColumn("int", at_least=0),
    "adr": TypedColumn("float", at_least=0),
    "is_repeated_guest": TypedColumn("int", allowed=[0, 1]),
}


def column_errors(columns: Sequence[str], allow_derived: bool = False) -> list[tuple[str, str]]:
    """Missing and unexpected column names, in the order of the schema and of the table."""
    allowed = {*schema.RAW_COLUMNS, CORRUPT, *(schema.DERIVED_COLUMNS if allow_derived else ())}
    missing = [c for c in schema.RAW_COLUMNS if c not in set(columns)]
    unexpected = [c for c in columns if c not in allowed]
    found = []
    if missing:
        found.append(("missing_columns", f"Missing columns: {missing}"))
    if unexpected:
        found.append(("unexpected_columns", f"Unexpected columns: {unexpected}"))
    return found


def type_errors(df: DataFrame, columns: Sequence[str] = tuple(schema.NUMERIC_CHECKED_COLUMNS)) -> list[tuple[str, str]]:
    """Columns that must be numeric but have another type. Text is judged by its values, see :func:`text_rules`."""
    found = []
    for name in columns:
        if name in df.columns and not isinstance(df.schema[name].dataType, (T.NumericType, T.StringType)):
            kind = df.schema[name].dataType.simpleString()
            found.append((name, f"{name}: expected numeric type, got {kind}"))
    return found


def text_rules(df: DataFrame, columns: Sequence[str] | None = None, corrupt: str = CORRUPT) -> list[Rule]:
    """For a table read as text: records with a wrong number of fields, and present values of the wrong type.

    A good file breaks none of these, so the table can then be typed strictly.
    """
    rules = []
    if corrupt in df.columns:
        rules.append(Rule("corrupt_record", corrupt, F.col(corrupt).isNotNull(), f"{corrupt}: {{n}} records with a wrong number of fields"))
    numeric = [f.name for f in schema.CLEAN_SCHEMA.fields if isinstance(f.dataType, T.NumericType)]
    whole = {f.name for f in schema.CLEAN_SCHEMA.fields if isinstance(f.dataType, T.IntegralType)}
    for name in numeric if columns is None else columns:
        if name in df.columns and isinstance(df.schema[name].dataType, T.StringType):
            number = F.col(name).try_cast("double")
            rules.append(Rule("data_type", name, truthy(F.col(name).isNotNull() & number.isNull()), f"{name}: expected numeric type, {{n}} values are not"))
            if name in whole:
                rules.append(Rule("data_type", name, truthy(number != F.floor(number)), f"{name}: {{n}} values are not whole numbers"))
    return rules


def row_rules(
    df: DataFrame,
    years: Iterable[int] = tuple(schema.YEARS),
    domains: Mapping[str, Sequence[str]] | None = None,
) -> list[Rule]:
    """All row-level rules that apply to the columns present, in report order."""
    domains = schema.DOMAINS if domains is None else domains
    types = {f.name: f.dataType for f in df.schema.fields}

    def has(*names: str) -> bool:
        return all(n in types for n in names)

    def value(name: str) -> Column:
        """The column as a number for comparisons; text that is no number counts as missing."""
        if isinstance(types[name], T.StringType):
            return no_nan(F.col(name).try_cast("double"), T.DoubleType())
        return no_nan(name, types[name])

    rules: list[Rule] = []

    def add(name: str, column: str, bad: Column, text: str) -> None:
        rules.append(Rule(name, column, truthy(bad), f"{column}: {{n}} {text}"))

    critical = [c for c in schema.RAW_COLUMNS if c not in schema.OPTIONAL_MISSING_COLUMNS]
    for c in filter(has, critical):
        add("missing", c, no_nan(c, types[c]).isNull(), "missing values")
    for c in filter(has, schema.BINARY_COLUMNS):
        add("binary", c, outside(value(c), [0, 1]), "invalid binary values")
    for c in filter(has, schema.NON_NEGATIVE_COLUMNS):
        add("non_negative", c, value(c) < 0, "negative values")
    for c, top in schema.UPPER_BOUNDS.items():
        if has(c):
            add("upper_bound", c, value(c) > top, f"values above maximum allowed value {top}")
    for c, low in schema.LOWER_BOUNDS.items():
        if has(c):
            add("lower_bound", c, value(c) < low, f"values below minimum allowed value {low}")
    if has("arrival_date_month"):
        unknown = F.col("arrival_date_month").isNotNull() & month_number("arrival_date_month").isNull()
        add("month", "arrival_date_month", unknown, "invalid month values")
    if has("arrival_date_year"):
        add("year", "arrival_date_year", outside(value("arrival_date_year"), years), "invalid year values")
    for c, allowed in domains.items():
        if has(c):
            add("category", c, outside(c, allowed), "invalid category values")
    parts = ["arrival_date_year", "arrival_date_month", "arrival_date_day_of_month"]
    if has(*parts):
        present = F.lit(True)
        for part in parts:
            present = present & F.col(part).isNotNull()
        built = arrival_date(*parts, strict=False)
        add("date", "arrival_date", present & built.isNull(), "invalid dates")
    for c in ["reservation_status_date"]:
        if has(c):
            add("date", c, _unreadable_date(c, types[c]), "invalid date values")
    if has(*schema.GUEST_COLUMNS):
        add("guests", "guest_count", guest_total(types) == 0, "rows with zero guests")
    for c in ["arrival_date", "booking_date"]:
        if has(c):
            add("derived_date", c, _unreadable_date(c, types[c]), "invalid date values")
    return rules


def guest_total(types: Mapping[str, T.DataType], columns: Sequence[str] = tuple(schema.GUEST_COLUMNS)) -> Column:
    """Guests of a booking with missing counts as 0."""
    total = F.lit(0.0)
    for name in columns:
        count = F.col(name).try_cast("double") if isinstance(types[name], T.StringType) else F.col(name).cast("double")
        total = total + F.coalesce(F.nanvl(count, F.lit(0.0)), F.lit(0.0))
    return total


def _unreadable_date(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(False)
    return F.col(name).isNotNull() & F.try_to_date(F.col(name), "yyyy-MM-dd").isNull()


def typed_rules(df: DataFrame, declared: Mapping[str, TypedColumn]) -> list[Rule]:
    """Rules of a declared typed schema; columns outside it are allowed."""
    kinds = {"str": T.StringType, "int": T.IntegralType, "float": T.FractionalType}
    rules = []
    for name, spec in declared.items():
        if name not in df.columns:
            rules.append(Rule("declared_column", name, F.lit(True), f"{name}: column not found ({{n}} rows)"))
            continue
        if not isinstance(df.schema[name].dataType, kinds[spec.kind]):
            rules.append(Rule("declared_type", name, F.lit(True), f"{name}: not of type {spec.kind} ({{n}} rows)"))
            continue
        rules.append(Rule("declared_null", name, F.col(name).isNull(), f"{name}: {{n}} null values"))
        if spec.allowed is not None:
            bad = outside(name, spec.allowed)
            rules.append(Rule("declared_values", name, bad, f"{name}: {{n}} values not in {list(spec.allowed)}"))
        if spec.at_least is not None:
            bad = truthy(F.col(name) < spec.at_least)
            rules.append(Rule("declared_minimum", name, bad, f"{name}: {{n}} values below {spec.at_least}"))
    return rules


def count_rules(df: DataFrame, rules: Sequence[Rule], first_position: int = 0) -> DataFrame:
    """One row per rule with its number of bad rows. One scan, one partial aggregate, one output row per rule."""
    counts = df.agg(*[F.count_if(rule.bad).alias(f"n{i}") for i, rule in enumerate(rules)])
    lines = [
        F.struct(
            F.lit(first_position + i).cast("int").alias("position"),
            F.lit(rule.name).alias("rule"),
            F.lit(rule.column).alias("column"),
            F.col(f"n{i}").alias("n_bad"),
            rule.message(F.col(f"n{i}")).alias("message"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def validation_report(
    df: DataFrame,
    allow_derived: bool = False,
    errors_only: bool = True,
    years: Iterable[int] = tuple(schema.YEARS),
    domains: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Errors of a table as rows ``(position, rule, column, n_bad, message)`` in a fixed order.

    Column-level findings have no ``n_bad``. ``errors_only=False`` also lists the rules that hold.
    """
    structural = [("columns", None, text) for _, text in column_errors(df.columns, allow_derived)]
    structural += [("data_type", name, text) for name, text in type_errors(df)]
    head = [(i, rule, name, None, text) for i, (rule, name, text) in enumerate(structural)]
    report = count_rules(df, text_rules(df) + row_rules(df, years, domains), len(head))
    if errors_only:
        report = report.filter(F.col("n_bad") > 0)
    if head:
        report = df.sparkSession.createDataFrame(head, REPORT_SCHEMA).unionByName(report)
    return report


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null (or NaN) count of every column that has any. For information only."""
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(no_nan(c, types[c]).isNull()).alias(c) for c in columns])
    lines = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_missing")) for c in columns]
    return counts.select(F.inline(F.array(*lines))).filter(F.col("n_missing") > 0)


def check(df: DataFrame, record_only: bool = False, stop_on: Sequence[str] = (), **options) -> list[str]:
    """Run the report. Raises on errors, or returns their messages when ``record_only``.

    Broken rules named in ``stop_on`` raise in any case. The report has one row per broken
    rule, a number fixed by the schema.
    """
    report = validation_report(df, **options).orderBy("position").select("rule", "message")
    errors = [(row.rule, row.message) for row in report.toLocalIterator()]
    stops = [text for rule, text in errors if not record_only or rule in stop_on]
    if stops:
        raise ValidationFailed(stops)
    return [text for _, text in errors]


def check_typed(df: DataFrame, declared: Mapping[str, TypedColumn] = TYPED_BOOKING) -> None:
    """Raise when the table breaks a declared typed schema."""
    report = count_rules(df, typed_rules(df, declared)).filter(F.col("n_bad") > 0).orderBy("position")
    errors = [row.message for row in report.toLocalIterator()]
    if errors:
        raise ValidationFailed(errors)
