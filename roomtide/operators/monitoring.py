"""Weekly retraining decision, cooldown, and the promotion gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide import schema
from roomtide.operators.drift import MAX_ECE, MAX_PR_AUC_DROP, PRIOR_SHIFT_LIMIT
from roomtide.operators.metrics import METRICS, compute_metrics

COOLDOWN_WEEKS = 4
NO_ACTION = "-"
DRY_RUN = "would retrain (dry run)"
PROMOTED = "retrain, gate passed, promoted"
KEPT = "retrain, gate failed, champion kept"


def weekly_stats(df: DataFrame, week: str = "week", day: str = "arrival_date", label: str = schema.TARGET) -> DataFrame:
    """Rows, label rate and the day after the last one, per week."""
    return df.groupBy(week).agg(
        F.count("*").alias("n_rows"),
        F.round(F.avg(label), 4).alias("cancel_rate"),
        F.date_add(F.max(F.col(day).cast("date")), 1).alias("cutoff"),
    )


def first_weeks(df: DataFrame, count: int, week: str = "week") -> DataFrame:
    """Rows of the earliest ``count`` weeks that occur. One row per week is looked at."""
    earliest = df.select(week).distinct().orderBy(week).limit(count)
    return df.join(earliest, week, "left_semi")


def retrain_decision(
    alerts: DataFrame, prior: DataFrame, performance: DataFrame, week: str = "week", limit: float = PRIOR_SHIFT_LIMIT
) -> DataFrame:
    """One row per week: the signal and its reasons, data drift first, then prior, then performance.

    All three inputs have one row per week.
    """
    joined = (
        prior.select(week, F.struct(*[c for c in prior.columns if c != week]).alias("prior_shift"))
        .join(alerts, week, "left")
        .join(
            performance.select(week, F.struct(*[c for c in performance.columns if c != week]).alias("concept_drift")),
            week,
            "left",
        )
    )
    n_alerts = F.coalesce("n_alerts", F.lit(0))
    reasons = F.concat(
        F.array_compact(
            F.array(
                F.when(n_alerts > 0, F.format_string("Data drift detected %d drift alert(s)", n_alerts)),
                F.when(F.col("prior_shift.triggered"), F.lit(f"Cancellation-rate gap exceeded {limit:.0%}")),
            )
        ),
        F.coalesce("concept_drift.reasons", F.array().cast("array<string>")),
    )
    return joined.select(
        week,
        (F.size(reasons) > 0).alias("retrain"),
        reasons.alias("reasons"),
        F.struct(n_alerts.alias("drift_alerts"), "prior_shift", "concept_drift").alias("evidence"),
    )


def cooldown_actions(
    signals: DataFrame,
    keys: Sequence[str] = (),
    week: str = "week",
    signal: str = "retrain",
    cooldown: int = COOLDOWN_WEEKS,
    acted: str = DRY_RUN,
) -> DataFrame:
    """Action per week: act on a signal unless an action less than ``cooldown`` weeks ago blocks it.

    Each step depends on the ones before, so the weeks of a model are folded in order;
    there is one small entry per calendar week.
    """
    weeks = F.array_sort(F.collect_list(F.struct(F.col(week).cast("int").alias("week"), F.col(signal).alias("signal"))))
    start = F.struct(
        F.lit(None).cast("int").alias("last"),
        F.array().cast("array<struct<week:int,action:string>>").alias("done"),
    )

    def step(state: Column, entry: Column) -> Column:
        blocked = F.coalesce(entry["week"] - state["last"] < cooldown, F.lit(False))
        acts = F.coalesce(entry["signal"], F.lit(False)) & ~blocked
        until = F.concat(F.lit("skipped (cooldown until week "), (state["last"] + cooldown).cast("string"), F.lit(")"))
        action = (
            F.when(acts, F.lit(acted)).when(F.coalesce(entry["signal"], F.lit(False)), until).otherwise(F.lit(NO_ACTION))
        )
        return F.struct(
            F.when(acts, entry["week"]).otherwise(state["last"]).alias("last"),
            F.concat(state["done"], F.array(F.struct(entry["week"].alias("week"), action.alias("action")))).alias("done"),
        )

    folded = signals.groupBy(*keys).agg(weeks.alias("weeks"))
    done = folded.select(*keys, F.aggregate("weeks", start, step)["done"].alias("done"))
    return done.select(*keys, F.inline("done"))


def simulation_summary(stats: DataFrame, decisions: DataFrame, cooldown: int = COOLDOWN_WEEKS, week: str = "week") -> DataFrame:
    """The weekly report of a dry run: rows, rate, signal, reasons as text and action."""
    actions = cooldown_actions(decisions, week=week, cooldown=cooldown)
    return (
        stats.join(decisions, week)
        .join(actions.withColumnRenamed("week", week), week)
        .select(
            week,
            "n_rows",
            "cancel_rate",
            F.col("retrain").alias("retrain_signal"),
            F.array_join("reasons", "; ").alias("reasons"),
            "action",
        )
        .orderBy(week)
    )


def total_profit(results: DataFrame, alias: str = "alias") -> DataFrame:
    """Profit of a backtest per model, to four decimals."""
    return results.groupBy(alias).agg(F.round(F.sum("profit"), 4).alias("profit"))


def promotion_gate(
    scored: DataFrame,
    profits: DataFrame | None = None,
    cutoff: str | None = None,
    label: str = "y",
    score: str = "p",
    alias: str = "alias",
    max_ece: float = MAX_ECE,
    max_drop: float = MAX_PR_AUC_DROP,
) -> DataFrame:
    """One nested document: may the candidate replace the champion?

    ``scored`` has the same test rows once per alias. Metrics are rounded to four decimals
    before they are compared. Without a champion only the calibration limit applies.
    """
    metrics = compute_metrics(scored, label, score, [alias])
    rounded = metrics.select(F.col(alias).alias("alias"), *[F.round(m, 4).alias(m) for m in METRICS])
    if profits is not None:
        rounded = rounded.join(profits.select(F.col(alias).alias("alias"), F.col("profit").cast("double").alias("profit")), "alias", "left")
    else:
        rounded = rounded.withColumn("profit", F.lit(None).cast("double"))
    values = F.struct(*METRICS)
    sides = rounded.agg(
        *[F.max(F.when(F.col("alias") == side, values)).alias(side) for side in ("candidate", "champion")],
        *[F.max(F.when(F.col("alias") == side, F.col("profit"))).alias(f"profit_{side}") for side in ("candidate", "champion")],
    )
    mine, theirs = F.col("profit_candidate"), F.col("profit_champion")
    has_champion = F.col("champion").isNotNull()
    checked = F.when(F.col("candidate").isNull(), F.raise_error(F.lit("no candidate to check")).cast("boolean")).otherwise(has_champion)
    profit = F.when(
        checked, F.struct(mine.alias("candidate"), theirs.alias("champion"), F.round(mine - theirs, 4).alias("delta"))
    )
    own, best = F.col("candidate.pr_auc"), F.col("champion.pr_auc")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("candidate.ece") > max_ece, F.concat(F.lit("ECE "), F.col("candidate.ece").cast("string"), F.lit(f" > {max_ece}"))),
            F.when(
                own < best - max_drop,
                F.concat(F.lit("PR-AUC "), own.cast("string"), F.lit(" is below champion "), best.cast("string"), F.lit(f" by more than {max_drop}")),
            ),
            F.when(
                has_champion & (mine < theirs),
                F.concat(F.lit("profit "), mine.cast("string"), F.lit(" is below champion "), theirs.cast("string")),
            ),
        )
    )
    rules = F.struct(
        F.lit(max_ece).alias("max_ece"), F.lit(max_drop).alias("max_pr_auc_drop"), F.lit(True).alias("min_profit_vs_champion")
    )
    return sides.select(
        F.lit(cutoff).alias("cutoff"),
        (F.size(reasons) == 0).alias("passed"),
        reasons.alias("reasons"),
        "candidate",
        "champion",
        profit.alias("profit"),
        rules.alias("rules"),
    )
