"""Leakage-safe model features, the same expressions for training and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomtide import schema
from roomtide.functions.columns import code_or_unknown, missing_flag
from roomtide.operators.profiling import baseline_rates


class LeakageError(ValueError):
    """A column known only after the stay reached the features."""


def not_features() -> list[str]:
    return [schema.TARGET, *schema.LEAKAGE_COLUMNS, *schema.EXCLUDED_FEATURES, *schema.DERIVED_COLUMNS]


def drop_non_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop target, leakage, excluded and derived columns; raises when one is absent."""
    names = not_features()
    absent = [c for c in names if c not in df.columns]
    if absent:
        raise ValueError(f"columns expected but not found: {absent}")
    return df.drop(*[c for c in names if c not in keep])


def fill_optional_missing(df: DataFrame) -> DataFrame:
    """Flags and constants for the four columns that may be missing."""
    flags = {f"{c}_missing": missing_flag(c) for c in ("country", "agent", "company", "children")}
    filled = {
        "country": F.coalesce("country", F.lit("Unknown")),
        "agent": code_or_unknown("agent"),
        "company": code_or_unknown("company"),
        "children": F.coalesce("children", F.lit(0)),
    }
    return df.withColumns(flags).withColumns(filled)


def build_features(df: DataFrame, include_team_decision: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns from cleaned bookings. ``keep`` carries columns along, e.g. the label."""
    features = fill_optional_missing(drop_non_features(df, keep))
    if not include_team_decision:
        features = features.drop(*schema.TEAM_DECISION_COLUMNS)
    check_no_leakage(features, allowed=keep)
    return features


def check_no_leakage(df: DataFrame, allowed: Sequence[str] = ()) -> None:
    banned = [c for c in schema.LEAKAGE_COLUMNS if c in df.columns and c not in allowed]
    if banned:
        raise LeakageError(f"known only after the stay: {banned}")


def feature_lists(columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical features that are present."""
    present = set(columns)
    return (
        [c for c in schema.NUMERIC_FEATURES if c in present],
        [c for c in schema.CATEGORICAL_FEATURES if c in present],
    )


def target(df: DataFrame) -> DataFrame:
    return df.select(schema.TARGET)


def drop_duplicates_from_train(df: DataFrame) -> DataFrame:
    """Remove every member of a group of copies. For the training split only."""
    if "is_duplicate" not in df.columns:
        raise ValueError("column is_duplicate not found: the table has not been cleaned")
    return df.filter(~F.col("is_duplicate"))


def align(df: DataFrame, declared: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly the declared columns: absent ones become their default or null, others go."""
    defaults = defaults or {}
    have = set(df.columns)
    out = []
    for field in declared.fields:
        value = F.col(field.name).cast(field.dataType) if field.name in have else F.lit(None).cast(field.dataType)
        if field.name in defaults and field.name not in have:
            value = F.lit(defaults[field.name]).cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(out)


def baseline_predict(
    train: DataFrame,
    rows: DataFrame,
    keys: Sequence[str] = ("hotel", "arrival_date_month"),
    label: str = schema.TARGET,
    out: str = "p_cancel",
) -> DataFrame:
    """Score rows with the training rate of their group, or the overall rate for an unseen group.

    The overall rate follows from the groups; nothing runs before the result is asked for.
    """
    keys = list(keys)
    rates = baseline_rates(train, keys, label)
    overall = rates.agg(F.sum("_positives") / F.sum("_n")).scalar()
    scored = rows.join(rates, keys, "left")
    return scored.withColumn(out, F.coalesce("baseline_rate", overall)).drop("baseline_rate", "_positives", "_n")
