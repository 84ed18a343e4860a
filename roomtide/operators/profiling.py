"""Rates and distributions by group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide import schema
from roomtide.functions.columns import month_key
from roomtide.operators.quantiles import exact_quantiles


def rate_by_month_hotel(
    df: DataFrame, day: str = "arrival_date", hotel: str = "hotel", label: str = schema.TARGET, ordered: bool = True
) -> DataFrame:
    """Bookings, cancellations and cancellation rate per arrival month and hotel."""
    found = df.groupBy(month_key(day).alias("arrival_month"), F.col(hotel).alias("hotel")).agg(
        F.count("*").alias("bookings"),
        F.sum(label).cast("bigint").alias("cancellations"),
        F.avg(label).alias("cancellation_rate"),
    )
    return found.orderBy("arrival_month", "hotel") if ordered else found


def share(column: str, value: object) -> Column:
    """Percentage of the present values of ``column`` that equal ``value``; 0 when there are none."""
    return F.coalesce(F.avg(F.when(F.col(column).isNotNull(), F.when(F.col(column) == value, 100.0).otherwise(0.0))), F.lit(0.0))


def split_comparison(
    df: DataFrame,
    shares: Mapping[str, tuple[str, object]] | None = None,
    lead: str = "lead_time",
    label: str = schema.TARGET,
    split: str = "split",
    exact_median: bool = True,
) -> DataFrame:
    """Per split: rows, shares of chosen values, mean and median lead time, cancellation rate.

    ``shares`` maps an output name to (column, value). The exact median counts equal
    values before it puts them in order; the other form uses an approximate sketch.
    """
    if shares is None:
        shares = {
            f"{name}_{value.replace(' ', '_')}_pct": (column, value)
            for name, column in (("hotel", "hotel"), ("deposit", "deposit_type"))
            for value in sorted(schema.DOMAINS[column])
        }
    rows = df.filter(F.col(split).isNotNull())
    aggregates = [F.count("*").alias("n_rows")]
    aggregates += [share(column, value).alias(name) for name, (column, value) in shares.items()]
    aggregates += [F.avg(lead).alias("lead_time_mean"), F.avg(label).alias("cancellation_rate")]
    if not exact_median:
        aggregates.append(F.approx_percentile(lead, 0.5, 100_000).cast("double").alias("lead_time_median"))
        return rows.groupBy(split).agg(*aggregates)
    medians = exact_quantiles(rows, lead, {"lead_time_median": 0.5}, [split])
    # both sides have one row per split
    return rows.groupBy(split).agg(*aggregates).join(medians, split, "left")


def class_balance(df: DataFrame, label: str = schema.TARGET) -> DataFrame:
    """Rows and share of every label value."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def profile_rate(
    df: DataFrame, keys: Sequence[str], label: str = schema.TARGET, measures: Sequence[str] = ()
) -> DataFrame:
    """Rows, share of all rows and label rate per group, with mean and deviation of ``measures``."""
    aggregates = [F.count("*").alias("n"), F.avg(label).alias("rate")]
    for name in measures:
        aggregates += [F.avg(name).alias(f"{name}_mean"), F.stddev(name).alias(f"{name}_std")]
    return df.groupBy(*keys).agg(*aggregates).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct values of each column."""
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns])


def baseline_rates(df: DataFrame, keys: Sequence[str], label: str = schema.TARGET) -> DataFrame:
    """Label rate of every group, with its sums so that the overall rate follows from the groups."""
    return df.groupBy(*keys).agg(
        F.avg(label).alias("baseline_rate"), F.sum(label).alias("_positives"), F.count(label).alias("_n")
    )
