"""Exact quantiles (linear interpolation) without holding a group in one task.

Equal values are first counted with map-side combining. The number of values per range
tells which range every wanted rank falls into, and only the values of those ranges
are put in order. Ranges hold about equal shares, so no range is large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions.columns import no_nan
from roomtide.operators.ranking import ROWS_PER_RANGE, ranges_for, with_value_ranges


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    keys: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per group with a column per entry of ``quantiles`` (output name to level).

    Rows without a group or value are left out.
    """
    keys = list(keys)
    present = df.select(*keys, no_nan(F.col(value).cast("double")).alias("_v"))
    for name in [*keys, "_v"]:
        present = present.filter(F.col(name).isNotNull())
    ranges = ranges_for(present.count(), rows_per_range)
    counted = with_value_ranges(present, "_v", ranges, "_slot").groupBy(*keys, "_slot", "_v").agg(F.count("*").alias("_n"))
    ordered = _placed(counted, keys) if ranges == 1 else _placed_in_ranges(counted, keys, quantiles)
    picks = []
    for name, level in quantiles.items():
        at = F.lit(float(level)) * (F.col("_total") - 1)
        holds_low = (F.floor(at) >= F.col("_from")) & (F.floor(at) < F.col("_to"))
        holds_high = (F.ceil(at) >= F.col("_from")) & (F.ceil(at) < F.col("_to"))
        picks += [
            F.max(F.when(holds_low, F.col("_v"))).alias(f"_lo_{name}"),
            F.max(F.when(holds_high, F.col("_v"))).alias(f"_hi_{name}"),
        ]
    found = ordered.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    out = []
    for name, level in quantiles.items():
        at = F.lit(float(level)) * (F.col("_total") - 1)
        lower, upper = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lower + (upper - lower) * (at - F.floor(at))).alias(name))
    return found.select(*keys, *out)


def _placed(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Values with the ranks they cover, for a number of values that fits one range."""
    inside = Window.partitionBy(*keys).orderBy("_v")
    return counted.select(
        *keys,
        "_v",
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
        (F.sum("_n").over(inside) - F.col("_n")).alias("_from"),
        F.sum("_n").over(inside).alias("_to"),
    )


def _placed_in_ranges(counted: DataFrame, keys: list[str], quantiles: Mapping[str, float]) -> DataFrame:
    """Values of the ranges that hold a wanted rank, with the ranks they cover."""
    # at most one row per group and range
    per_slot = counted.groupBy(*keys, "_slot").agg(F.sum("_n").alias("_in_slot"))
    along = Window.partitionBy(*keys).orderBy("_slot")
    whole = Window.partitionBy(*keys)
    per_slot = per_slot.select(
        *keys,
        "_slot",
        (F.sum("_in_slot").over(along) - F.col("_in_slot")).alias("_before"),
        F.sum("_in_slot").over(along).alias("_through"),
        F.sum("_in_slot").over(whole).alias("_total"),
    )
    targets = []
    for name, level in quantiles.items():
        exact = F.lit(float(level)) * (F.col("_total") - 1)
        targets.append(F.struct(F.lit(name).alias("name"), exact.alias("at")))
    wanted = per_slot.withColumn("_t", F.explode(F.array(*targets)))
    hit = (F.ceil("_t.at") >= F.col("_before")) & (F.floor("_t.at") < F.col("_through"))
    needed = per_slot.join(wanted.filter(hit).select(*keys, "_slot").distinct(), [*keys, "_slot"], "left_semi")

    inside = Window.partitionBy(*keys, "_slot").orderBy("_v")
    return counted.join(needed, [*keys, "_slot"]).select(
        *keys,
        "_v",
        "_total",
        (F.col("_before") + F.sum("_n").over(inside) - F.col("_n")).alias("_from"),
        (F.col("_before") + F.sum("_n").over(inside)).alias("_to"),
    )
