"""Quality of scored tables: ranking, loss and calibration measures, all in one pass.

Everything is computed from the *score table*: rows and positives per distinct score. It
is the only shuffle of the scored rows and combines map-side, so a score shared by a
third of all rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomtide.functions.binning import calibration_error_bin, reliability_bin
from roomtide.operators.ranking import ROWS_PER_RANGE, ranges_for, with_value_ranges

EPSILON = 2.220446049250313e-16
METRICS = ["pr_auc", "roc_auc", "log_loss", "brier", "ece"]


def score_table(df: DataFrame, label: str = "y", score: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """Rows and positives per group and distinct score. Rows without a group, label or score are left out."""
    for name in [*keys, label, score]:
        df = df.filter(F.col(name).isNotNull())
    grouped = df.groupBy(*keys, F.col(score).cast("double").alias("p"))
    return grouped.agg(F.count("*").alias("n"), F.sum(label).cast("bigint").alias("pos"))


def cumulative(scores: DataFrame, keys: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add rows and positives at or above each score.

    The distinct scores are cut into ranges of about equal numbers of them, wherever they lie;
    running sums are taken inside a range, and a table with one row per group and range carries
    the totals of all higher ones. A larger table has more ranges, and no group runs in one task.
    """
    keys = list(keys)
    ranges = ranges_for(scores.count(), rows_per_range)
    banded = with_value_ranges(scores, "p", ranges, "_band")
    above = Window.partitionBy(*keys).orderBy(F.col("_band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    bands = banded.groupBy(*keys, "_band").agg(F.sum("n").alias("_n"), F.sum("pos").alias("_pos"))
    carried = bands.select(
        *keys,
        "_band",
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n_above"),
        F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_pos_above"),
        F.sum("_n").over(whole).alias("n_total"),
        F.sum("_pos").over(whole).alias("pos_total"),
    )
    inside = Window.partitionBy(*keys, "_band").orderBy(F.col("p").desc())
    running = banded.withColumns({"_n_in": F.sum("n").over(inside), "_pos_in": F.sum("pos").over(inside)})
    # a left join adds no null filter to one side only, so both sides share the shuffle of the score table
    joined = running.join(carried, [*keys, "_band"], "left")
    return joined.select(
        *keys,
        "p",
        "n",
        "pos",
        (F.col("_n_above") + F.col("_n_in")).alias("n_cum"),
        (F.col("_pos_above") + F.col("_pos_in")).alias("pos_cum"),
        "n_total",
        "pos_total",
    )


def _ranking_sums() -> dict[str, Column]:
    neg, positives_above = F.col("n") - F.col("pos"), F.col("pos_cum") - F.col("pos")
    return {
        "_ap": F.sum(F.col("pos") * F.col("pos_cum") / F.col("n_cum")),
        "_pairs": F.sum(neg * (positives_above + F.col("pos") / 2)),
        "_n": F.max("n_total"),
        "_p": F.max("pos_total"),
    }


def _loss_sums() -> dict[str, Column]:
    safe = F.greatest(F.lit(EPSILON), F.least(F.lit(1.0 - EPSILON), F.col("p")))
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    return {
        "_log": F.sum(-(pos * F.log(safe) + neg * F.log(1 - safe))),
        "_sq": F.sum(pos * F.pow(1 - F.col("p"), 2) + neg * F.pow(F.col("p"), 2)),
    }


def _gap_sums(n_bins: int) -> dict[str, Column]:
    sums = {}
    bin_of = calibration_error_bin("p", n_bins)
    for b in range(n_bins):
        signed = F.when(bin_of == b, F.col("pos") - F.col("n") * F.col("p")).otherwise(0.0)
        sums[f"_gap{b}"] = F.sum(signed)
    return sums


def compute_metrics(
    df: DataFrame,
    label: str = "y",
    score: str = "p",
    keys: Sequence[str] = (),
    n_bins: int = 10,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Average precision, ROC AUC, log loss, Brier score and calibration error per group.

    Average precision is the step sum over distinct scores; ties in the AUC count half.
    The calibration error adds |positives - expected positives| over the bins, which is
    the weighted gap between accuracy and confidence. Without positives or without
    negatives the AUC is null.
    """
    keys = list(keys)
    scores = cumulative(score_table(df, label, score, keys), keys, rows_per_range)
    sums = {**_ranking_sums(), **_loss_sums(), **_gap_sums(n_bins)}
    totals = scores.groupBy(*keys).agg(*[column.alias(name) for name, column in sums.items()])
    gaps = F.lit(0.0)
    for b in range(n_bins):
        gaps = gaps + F.abs(f"_gap{b}")
    n, positives = F.col("_n"), F.col("_p")
    return totals.select(
        *keys,
        n.alias("n_rows"),
        F.coalesce(F.try_divide(F.col("_ap"), positives), F.lit(0.0)).alias("pr_auc"),
        F.try_divide(F.col("_pairs"), positives.cast("double") * (n - positives)).alias("roc_auc"),
        (F.col("_log") / n).alias("log_loss"),
        (F.col("_sq") / n).alias("brier"),
        (gaps / n).alias("ece"),
    )


def metrics_by_column(
    df: DataFrame, scores: Mapping[str, str], label: str = "y", keys: Sequence[str] = (), name: str = "stage"
) -> DataFrame:
    """The metrics for several score columns of the same rows, e.g. before and after calibration."""
    stages = [F.struct(F.lit(stage).alias(name), F.col(column).alias("p")) for stage, column in scores.items()]
    long = df.select(*keys, F.col(label).alias("y"), F.inline(F.array(*stages)))
    return compute_metrics(long, "y", "p", [*keys, name])


def expected_calibration_error(
    df: DataFrame, label: str = "y", score: str = "p", keys: Sequence[str] = (), n_bins: int = 10
) -> DataFrame:
    """Calibration error alone: one grouped pass over at most ``n_bins`` rows per group and task."""
    binned = df.select(*keys, F.col(label).alias("y"), F.col(score).alias("p"), calibration_error_bin(score, n_bins).alias("bin"))
    bins = binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.avg("y").alias("acc"), F.avg("p").alias("conf"))
    gap = F.sum(F.col("n") * F.abs(F.col("acc") - F.col("conf"))) / F.sum("n")
    return bins.groupBy(*keys).agg(gap.alias("ece"))


def reliability_curve(
    df: DataFrame, label: str = "y", score: str = "p", keys: Sequence[str] = (), n_bins: int = 10
) -> DataFrame:
    """Mean score and positive rate of every bin that is not empty."""
    binned = df.select(*keys, F.col(label).alias("y"), F.col(score).alias("p"), reliability_bin(score, n_bins).alias("bin"))
    return binned.groupBy(*keys, "bin").agg(
        F.count("*").alias("n"), F.avg("p").alias("prob_pred"), F.avg("y").alias("prob_true")
    )


def with_label(df: DataFrame, score: str = "p", threshold: float = 0.5, out: str = "will_cancel") -> DataFrame:
    return df.withColumn(out, F.col(score) >= F.lit(threshold))
