"""Data, prior and performance drift of every period against a reference, in grouped jobs.

The period (a week, or a chunk of rows within one) is a grouping column, so all periods
are checked by the same job. Tables that reach the driver hold a few numbers per feature.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide import schema
from roomtide.functions.columns import no_nan
from roomtide.operators.metrics import compute_metrics
from roomtide.operators.quantiles import exact_quantiles
from roomtide.operators.ranking import ROWS_PER_RANGE, free_names, ranges_for, row_numbers, with_value_ranges

# Limits of the drift checks.
PRIOR_SHIFT_LIMIT = 0.05
MAX_PR_AUC_DROP = 0.03
MAX_ECE = 0.05
MIN_CHUNK, MAX_CHUNK = 100, 500
# Our own choices for the data drift test.
JS_LIMIT = 0.1
REFERENCE_BINS = 10
SHARE_FLOOR = 1e-4


def unpivot(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows ``(keys, feature, value)`` of the values that are present."""
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    long = df.select(*keys, F.inline(F.array(*pairs)))
    return long.filter(no_nan("value").isNotNull())


def check_columns(frames: Mapping[str, DataFrame], required: Sequence[str]) -> None:
    """Raise when a frame lacks a required column; all missing names are listed once, in order."""
    missing = sorted({c for frame in frames.values() for c in required if c not in frame.columns})
    if missing:
        raise ValueError("Missing required columns: " + ", ".join(missing))


# --- Prior shift ------------------------------------------------------------


def prior_shift(
    reference: DataFrame,
    current: DataFrame,
    label: str = schema.TARGET,
    keys: Sequence[str] = (),
    limit: float = PRIOR_SHIFT_LIMIT,
) -> DataFrame:
    """Gap between the label rates of the reference and of every period."""
    base = reference.agg(F.avg(label)).first()[0]
    rates = current.groupBy(*keys).agg(F.avg(label).alias("current_rate"))
    gap = F.abs(F.col("current_rate") - F.lit(base))
    return rates.select(
        *keys,
        F.lit(base).alias("reference_rate"),
        "current_rate",
        gap.alias("absolute_gap"),
        F.lit(limit).alias("threshold"),
        (gap > limit).alias("triggered"),
    )


# --- Data drift by chunk ----------------------------------------------------


def with_chunks(
    df: DataFrame,
    group: str,
    order_by: Column | str,
    tie_break: Column | str,
    smallest: int = MIN_CHUNK,
    largest: int = MAX_CHUNK,
    out: str = "chunk",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Number the rows of each group in order and cut them into chunks 0, 1, ...

    A chunk has as many rows as the group, within the two limits. Groups must follow
    the order, as weeks follow days; the position in a group is then a difference of
    positions in the table, and no group is gathered.
    """
    position, rows, start = free_names(df, "_position", "_size", "_start")
    numbered = row_numbers(df, order_by, tie_break, out=position, rows_per_range=rows_per_range)
    sizes = df.groupBy(group).agg(F.count("*").alias(rows))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)  # one row per period of the calendar
    starts = sizes.withColumn(start, F.coalesce(F.sum(rows).over(before), F.lit(0)))
    placed = numbered.join(starts, group)
    size = F.greatest(F.lit(smallest), F.least(F.col(rows), F.lit(largest)))
    chunk = F.floor((F.col(position) - F.col(start)) / size).cast("int")
    return placed.withColumn(out, chunk).drop(position, start, rows)


def reference_edges(
    reference: DataFrame, features: Sequence[str], n_bins: int = REFERENCE_BINS
) -> dict[str, list[float]]:
    """Inner bin edges per feature: the distinct quantiles of the reference. A few numbers per feature."""
    levels = {f"q{i}": i / n_bins for i in range(1, n_bins)}
    rows = exact_quantiles(unpivot(reference, features), "value", levels, ["feature"]).collect()
    return {row.feature: sorted({row[name] for name in levels}) for row in rows}


def _bin(feature: str, edges: Sequence[float]) -> Column:
    total = F.lit(0)
    for edge in edges:
        total = total + (F.col(feature).cast("double") > F.lit(edge)).cast("int")
    return total


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], keys: Sequence[str] = ()) -> DataFrame:
    """Rows per period, feature and bin; bounded by the number of bins, combined map-side."""
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.when(no_nan(F.col(f).cast("double")).isNotNull(), _bin(f, cuts)).alias("bin"),
        )
        for f, cuts in edges.items()
    ]
    long = df.select(*keys, F.inline(F.array(*entries))).filter(F.col("bin").isNotNull())
    return long.groupBy(*keys, "feature", "bin").agg(F.count("*").alias("n"))


def bin_shares(
    reference: DataFrame, current: DataFrame, edges: Mapping[str, Sequence[float]], keys: Sequence[str] = ()
) -> DataFrame:
    """Share of every bin in the reference (p) and in each period (q), empty bins included."""
    spark = current.sparkSession
    known = {(r.feature, r.bin): r.n for r in bin_counts(reference, edges).collect()}
    totals: dict[str, int] = {}
    for (feature, _), n in known.items():
        totals[feature] = totals.get(feature, 0) + n
    base = [
        (f, b, known.get((f, b), 0) / totals[f]) for f, cuts in edges.items() if f in totals for b in range(len(cuts) + 1)
    ]
    # bins times features rows
    bins = F.broadcast(spark.createDataFrame(base, "feature string, bin int, p double"))
    counts = bin_counts(current, edges, keys)
    sizes = counts.groupBy(*keys, "feature").agg(F.sum("n").alias("_total"))
    every = sizes.join(bins, "feature")
    filled = every.join(counts, [*keys, "feature", "bin"], "left")
    q = F.coalesce("n", F.lit(0)) / F.col("_total")
    return filled.select(*keys, "feature", "bin", "p", q.alias("q"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) as an aggregate over bins."""
    middle = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)

    return F.sqrt(F.greatest(F.lit(0.0), F.sum((part(p) + part(q)) / 2)))


def psi(p: Column, q: Column, floor: float = SHARE_FLOOR) -> Column:
    """Population stability index as an aggregate over bins; empty shares count as ``floor``."""
    a, b = F.greatest(p, F.lit(floor)), F.greatest(q, F.lit(floor))
    return F.sum((b - a) * F.log(b / a))


def data_drift(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] = tuple(schema.DRIFT_FEATURES),
    keys: Sequence[str] = ("week", "chunk"),
    n_bins: int = REFERENCE_BINS,
    limit: float = JS_LIMIT,
) -> DataFrame:
    """Distance to the reference per period and feature, with an alert above ``limit``."""
    edges = reference_edges(reference, features, n_bins)
    shares = bin_shares(reference, current, edges, keys)
    found = shares.groupBy(*keys, "feature").agg(js_distance(F.col("p"), F.col("q")).alias("js_distance"))
    return found.withColumn("alert", F.col("js_distance") > limit)


def alert_count(drift: DataFrame, keys: Sequence[str] = ("week",)) -> DataFrame:
    return drift.groupBy(*keys).agg(F.count_if("alert").alias("n_alerts"))


# --- Column drift table -----------------------------------------------------


def distribution_gaps(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per feature: largest gap of the two distribution functions (KS) and the area between them.

    Both tables are first counted per distinct value. Running sums are then taken inside
    ranges of the values and shifted by the totals of the ranges before.
    """
    marked = [
        unpivot(frame, features).select("feature", "value", F.lit(r).alias("r"), F.lit(1 - r).alias("c"))
        for r, frame in ((1, reference), (0, current))
    ]
    both = marked[0].unionAll(marked[1])
    ranges = ranges_for(both.count(), rows_per_range)
    counted = with_value_ranges(both, "value", ranges, "_range").groupBy("feature", "_range", "value")
    counted = counted.agg(F.sum("r").alias("r"), F.sum("c").alias("c"))

    feature = Window.partitionBy("feature")
    before = feature.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = counted.groupBy("feature", "_range").agg(
        F.sum("r").alias("_r"), F.sum("c").alias("_c"), F.min("value").alias("_low")
    )
    carried = per_range.select(
        "feature",
        "_range",
        F.coalesce(F.sum("_r").over(before), F.lit(0)).alias("_r_before"),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_c_before"),
        F.sum("_r").over(feature).alias("_r_all"),
        F.sum("_c").over(feature).alias("_c_all"),
        F.lead("_low").over(feature.orderBy("_range")).alias("_next_low"),
    )
    inside = Window.partitionBy("feature", "_range").orderBy("value")
    running = counted.withColumns(
        {
            "_r_in": F.sum("r").over(inside),
            "_c_in": F.sum("c").over(inside),
            "_next": F.lead("value").over(inside),
        }
    ).join(carried, ["feature", "_range"], "left")
    gap = F.abs(
        (F.col("_r_before") + F.col("_r_in")) / F.col("_r_all") - (F.col("_c_before") + F.col("_c_in")) / F.col("_c_all")
    )
    step = F.coalesce("_next", "_next_low") - F.col("value")
    return running.groupBy("feature").agg(
        F.max(gap).alias("ks"), F.sum(F.coalesce(gap * step, F.lit(0.0))).alias("wasserstein")
    )


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] = tuple(schema.DRIFT_FEATURES),
    n_bins: int = REFERENCE_BINS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per feature: PSI, KS, and the Wasserstein distance in units of the reference's deviation."""
    edges = reference_edges(reference, features, n_bins)
    index = bin_shares(reference, current, edges).groupBy("feature").agg(psi(F.col("p"), F.col("q")).alias("psi"))
    spread = unpivot(reference, features).groupBy("feature").agg(F.stddev_pop("value").alias("_std"))
    gaps = distribution_gaps(reference, current, features, rows_per_range)
    # one row per feature on every side
    table = index.join(gaps, "feature").join(spread, "feature")
    normed = F.try_divide("wasserstein", "_std").alias("wasserstein_normed")
    return table.select("feature", "psi", "ks", normed)


# --- Performance drift ------------------------------------------------------


def performance_drift(
    baseline: DataFrame | None,
    current: DataFrame,
    label: str = "y",
    score: str = "p",
    keys: Sequence[str] = ("week",),
    max_drop: float = MAX_PR_AUC_DROP,
    max_ece: float = MAX_ECE,
) -> DataFrame:
    """Average precision and calibration of each period against a baseline, both strictly limited.

    Without a scored baseline (no model) nothing triggers and ``available`` is false.
    """
    if baseline is None:
        periods = current.groupBy(*keys).agg(F.count("*").alias("n_rows"))
        nothing = {name: F.lit(None).cast("double").alias(name) for name in ("pr_auc", "ece", "baseline_pr_auc", "baseline_ece", "pr_auc_drop")}
        flags = [F.lit(False).alias(name) for name in ("available", "pr_auc_triggered", "ece_triggered", "triggered")]
        return periods.select(*keys, "n_rows", *nothing.values(), *flags, F.array().cast("array<string>").alias("reasons"))
    base = compute_metrics(baseline, label, score).first()
    found = compute_metrics(current, label, score, keys).select(*keys, "n_rows", "pr_auc", "ece")
    found = found.withColumns(
        {
            "baseline_pr_auc": F.lit(base.pr_auc),
            "baseline_ece": F.lit(base.ece),
            "pr_auc_drop": F.lit(base.pr_auc) - F.col("pr_auc"),
            "available": F.lit(True),
        }
    )
    drop, error = F.col("pr_auc_drop") > max_drop, F.col("ece") > max_ece
    reasons = F.array_compact(
        F.array(
            F.when(drop, F.format_string(f"Concept/performance drift: PR-AUC dropped by %.4f (>{max_drop:.2f})", "pr_auc_drop")),
            F.when(error, F.format_string(f"Concept/performance drift: ECE %.4f >{max_ece:.2f}", "ece")),
        )
    )
    return found.withColumns(
        {"pr_auc_triggered": drop, "ece_triggered": error, "triggered": drop | error, "reasons": reasons}
    )
