"""Rooms taken per night, and the capacity estimated from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions.columns import arrival_date, half_even, length_of_stay


def with_stay(df: DataFrame) -> DataFrame:
    """Stay date, length of stay and checkout date from the raw booking columns.

    An unknown month name gives a null stay date.
    """
    parts = ("arrival_date_year", "arrival_date_month", "arrival_date_day_of_month")
    weekend, week = (c if c in df.columns else None for c in ("stays_in_weekend_nights", "stays_in_week_nights"))
    dated = df.withColumn("stay_date", arrival_date(*parts, strict=False))
    dated = dated.withColumn("length_of_stay", length_of_stay(weekend, week))
    return dated.withColumn("checkout_date", F.date_add("stay_date", F.col("length_of_stay")))


def moves_per_day(
    df: DataFrame,
    hotel: str = "hotel",
    stay: str = "stay_date",
    nights: str = "length_of_stay",
    canceled: str | None = "is_canceled",
) -> DataFrame:
    """Arrivals and departures per hotel and day. Two small events per booking, combined map-side."""
    if canceled and canceled in df.columns:
        df = df.filter(F.col(canceled) == 0)
    day = F.col(stay).cast("date")
    events = F.array(
        F.struct(day.alias("date"), F.lit(1).alias("arrives"), F.lit(0).alias("departs")),
        F.struct(F.date_add(day, F.col(nights)).alias("date"), F.lit(0).alias("arrives"), F.lit(1).alias("departs")),
    )
    return (
        df.select(F.col(hotel).alias("hotel"), F.explode(events).alias("event"))
        .groupBy("hotel", F.col("event.date").alias("date"))
        .agg(F.sum("event.arrives").alias("arrivals"), F.sum("event.departs").alias("departures"))
    )


def nightly_occupancy(
    df: DataFrame,
    hotel: str = "hotel",
    stay: str = "stay_date",
    nights: str = "length_of_stay",
    canceled: str | None = "is_canceled",
) -> DataFrame:
    """Rooms taken per hotel and night from the first stay to the last, empty nights included.

    The window sees one row per hotel and day with a move, a number the calendar bounds.
    Each such row then covers the nights up to the next one, so no calendar join is needed.
    """
    moves = moves_per_day(df, hotel, stay, nights, canceled)
    in_time = Window.partitionBy("hotel").orderBy("date")
    levels = moves.select(
        "hotel",
        "date",
        F.sum(F.col("arrivals") - F.col("departures")).over(in_time).alias("occupancy"),
        F.lead("date").over(in_time).alias("next_date"),
    ).filter(F.col("next_date").isNotNull())
    covered = F.explode(F.sequence(F.col("date"), F.date_sub("next_date", 1)))
    return levels.select("hotel", covered.alias("date"), "occupancy")


def nightly_occupancy_by_night(
    df: DataFrame,
    hotel: str = "hotel",
    stay: str = "stay_date",
    nights: str = "length_of_stay",
    canceled: str | None = "is_canceled",
) -> DataFrame:
    """The same table by listing every night of every stay. Fits streams; costs one row per night."""
    if canceled and canceled in df.columns:
        df = df.filter(F.col(canceled) == 0)
    day = F.col(stay).cast("date")
    last = F.date_add(day, F.col(nights) - 1)
    taken = df.select(F.col(hotel).alias("hotel"), F.explode(F.sequence(day, last)).alias("date"))
    counts = taken.groupBy("hotel", "date").agg(F.count("*").alias("occupancy"))
    ends = counts.groupBy("hotel").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    spine = ends.select("hotel", F.explode(F.sequence("first", "last")).alias("date"))
    filled = spine.join(counts, ["hotel", "date"], "left")
    return filled.select("hotel", "date", F.coalesce("occupancy", F.lit(0)).alias("occupancy"))


def estimate_capacity(occupancy: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Whole-room quantile of the nightly occupancy per hotel. Nights with no guests count.

    A hotel has one value per night, so the exact aggregate stays within the calendar.
    """
    level = half_even(F.percentile("occupancy", quantile))
    return occupancy.groupBy("hotel").agg(level.alias("capacity"))
