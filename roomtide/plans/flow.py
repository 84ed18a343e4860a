"""The whole batch flow and the weekly replay, as plain functions on one session.

Tables between steps are Parquet; each gate is an action that raises. Nothing here
schedules anything: a caller runs the functions in order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide import schema
from roomtide.config import CostConfig
from roomtide.operators import (
    backtest,
    cleaning,
    drift,
    features,
    models,
    monitoring,
    occupancy,
    overbooking,
    profiling,
    splitting,
    validation,
)
from roomtide.session import cut_lineage
from roomtide.sources import hashes, readers, writers


@dataclass
class Prepared:
    """Paths and findings of the data step."""

    clean_path: str
    split_path: str
    raw_errors: list[str] = field(default_factory=list)


def prepare_data(
    spark: SparkSession,
    raw_path: str,
    out: str,
    order_by: Column | str,
    sha256: str | None = None,
    tie_break: Column | str | None = None,
) -> Prepared:
    """Verify, validate, clean, validate again, split, check and store.

    Values out of range in the raw file are recorded only; records and values that cannot be
    typed stop the flow, as do errors of the cleaned table. The file is judged as text, before
    any value is typed, and then typed strictly. ``order_by`` declares the order behind ``row_id`` (an extra column of the raw file, or
    an expression over its columns).
    """
    if sha256:
        hashes.verify_checksum(spark, raw_path, sha256)
    text = readers.read_csv_text(spark, raw_path, corrupt=readers.CORRUPT)
    bookings = text.select(*[c for c in text.columns if c in schema.RAW_COLUMNS], readers.CORRUPT)
    errors = validation.check(bookings, record_only=True, stop_on=["columns", "corrupt_record", "data_type", "date"])
    found = Prepared(f"{out}/clean", f"{out}/splits", errors)
    raw = readers.typed(text.drop(readers.CORRUPT), strict=True)
    writers.write_table(cleaning.clean(raw, order_by, tie_break), found.clean_path)
    clean = spark.read.parquet(found.clean_path)
    validation.check(clean, allow_derived=True)
    split = splitting.temporal_split(clean)
    splitting.check_split(clean, split)
    writers.write_partitioned(split, found.split_path, ["split"], ["arrival_date"])
    stored = spark.read.parquet(found.split_path)
    writers.write_documents(splitting.manifest(stored, columns=clean.columns), f"{out}/manifest")
    train = stored.filter(F.col("split") == "train")
    writers.write_table(profiling.rate_by_month_hotel(train), f"{out}/rate_by_month_hotel")
    writers.write_table(profiling.split_comparison(stored), f"{out}/split_comparison")
    return found


def decision_dataset(
    rows: DataFrame, model: models.CalibratedModel, prepare: Callable[[DataFrame], DataFrame] = features.build_features
) -> DataFrame:
    """The columns the decision needs, from cleaned bookings and a model.

    Scores stay on their rows, keyed by ``row_id``; nothing is matched by position.
    """
    stays = occupancy.with_stay(rows)
    kept = ["hotel", "stay_date", "adr", "is_canceled", "lead_time", "length_of_stay"]
    scored = model.score(prepare(rows, keep=["row_id"])).select("row_id", "p_cancel")
    return stays.select("row_id", *kept).join(scored, "row_id")


def decide(
    rows: DataFrame, config: CostConfig, out: str, sequential: bool = True, rates_from: DataFrame | None = None
) -> DataFrame:
    """Backtest the four policies on a scored dataset and store nights, summary and sensitivity.

    Monthly rates come from the evaluated rows themselves unless ``rates_from`` gives others.
    """
    run = backtest.backtest_sequential if sequential else backtest.backtest_policies
    rates = overbooking.monthly_rates(rates_from if rates_from is not None else rows)
    writers.write_table(run(rows, config, rates=rates), f"{out}/nights")
    summary = backtest.summarize(rows.sparkSession.read.parquet(f"{out}/nights"))
    writers.write_table(summary, f"{out}/summary")
    writers.write_table(backtest.sensitivity(rows, config, run, rates=rates), f"{out}/sensitivity")
    return rows.sparkSession.read.parquet(f"{out}/summary")


def retrain(
    clean: DataFrame,
    cutoff: date,
    champion: models.CalibratedModel | None,
    config: CostConfig,
    classifier: Estimator | None = None,
) -> tuple[models.CalibratedModel, DataFrame]:
    """Fit and calibrate on the window before ``cutoff`` and check the result against the champion."""
    window = cut_lineage(splitting.retrain_window(clean, cutoff), "window", ["split"])
    candidate, _ = models.train_calibrated(window, classifier)
    test = window.filter(F.col("split") == "test").drop("split")
    scored = profits = None
    for alias, model in (("candidate", candidate), ("champion", champion)):
        if model is None:
            continue
        rows = cut_lineage(decision_dataset(test, model), "gate")
        side = rows.select(F.lit(alias).alias("alias"), F.col("is_canceled").alias("y"), F.col("p_cancel").alias("p"))
        scored = side if scored is None else scored.unionByName(side)
        if champion is not None:
            walked = backtest.backtest_sequential(rows, config, policies=["model"])
            profit = monitoring.total_profit(walked.withColumn("alias", F.lit(alias)))
            profits = profit if profits is None else profits.unionByName(profit)
    return candidate, monitoring.promotion_gate(scored, profits, cutoff.isoformat())


def score_split(splits: DataFrame, name: str, model: models.CalibratedModel) -> DataFrame:
    part = splits.filter(F.col("split") == name).drop("split")
    keep = ["row_id", schema.TARGET]
    scored = model.score(features.build_features(part, keep=keep)).select("row_id", "p_cancel")
    return part.join(scored, "row_id")


def weekly_decisions(
    splits: DataFrame, model: models.CalibratedModel | None, drift_features: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Weekly statistics and retraining decisions of the production rows, all weeks in one pass."""
    names = list(drift_features or schema.DRIFT_FEATURES)
    drift.check_columns({"splits": splits}, [*names, schema.TARGET])
    train = splits.filter(F.col("split") == "train")
    if model is None:
        production, test = splits.filter(F.col("split") == "production").drop("split"), None
    else:
        production, test = score_split(splits, "production", model), score_split(splits, "test", model)
    weeks = cut_lineage(splitting.with_week(production), "weeks", ["week"])
    chunks = drift.with_chunks(weeks, "week", "arrival_date", "row_id")
    alerts = drift.alert_count(drift.data_drift(train, chunks, names))
    prior = drift.prior_shift(train, weeks, keys=["week"])
    score = "p_cancel" if model is not None else schema.TARGET
    performance = drift.performance_drift(test, weeks, schema.TARGET, score)
    return monitoring.weekly_stats(weeks), monitoring.retrain_decision(alerts, prior, performance)


def replay_production(
    splits: DataFrame,
    model: models.CalibratedModel | None,
    cooldown: int = monitoring.COOLDOWN_WEEKS,
    max_weeks: int | None = None,
    drift_features: list[str] | None = None,
    decide_weeks: Callable[..., tuple[DataFrame, DataFrame]] = weekly_decisions,
) -> DataFrame:
    """Dry run over the production weeks: what each week would have triggered.

    ``decide_weeks`` may be any function that gives weekly statistics and decisions.
    """
    stats, decisions = decide_weeks(splits, model, drift_features)
    if max_weeks:
        stats = monitoring.first_weeks(stats, max_weeks)
    return monitoring.simulation_summary(stats, decisions, cooldown)


def replay_with_retraining(
    clean: DataFrame,
    splits: DataFrame,
    champion: models.CalibratedModel,
    config: CostConfig,
    cooldown: int = monitoring.COOLDOWN_WEEKS,
    max_weeks: int | None = None,
    classifier: Estimator | None = None,
    drift_features: list[str] | None = None,
) -> tuple[DataFrame, models.CalibratedModel]:
    """The replay with real retraining. Only weeks that act are run one after another.

    A promoted model changes the performance check of later weeks, so decisions are taken
    anew after each promotion; everything within one pass stays grouped by week.
    """
    spark, last, log, done = splits.sparkSession, None, [], 0
    stats, decisions = weekly_decisions(splits, champion, drift_features)
    if max_weeks:
        stats = monitoring.first_weeks(stats, max_weeks)
    while True:
        # one small row per calendar week
        rows = stats.join(decisions, "week").filter(F.col("week") > done).orderBy("week").collect()
        promoted = False
        for row in rows:
            done, action = row.week, monitoring.NO_ACTION
            if row.retrain and last is not None and row.week - last < cooldown:
                action = f"skipped (cooldown until week {last + cooldown})"
            elif row.retrain:
                candidate, gate = retrain(clean, row.cutoff, champion, config, classifier)
                promoted = gate.first().passed
                action, last = (monitoring.PROMOTED if promoted else monitoring.KEPT), row.week
                champion = candidate if promoted else champion
            log.append((row.week, row.n_rows, row.cancel_rate, row.retrain, "; ".join(row.reasons), action))
            if promoted:
                break
        if not promoted:
            break
        stats, decisions = weekly_decisions(splits, champion, drift_features)
        if max_weeks:
            stats = monitoring.first_weeks(stats, max_weeks)
    columns = "week int, n_rows bigint, cancel_rate double, retrain_signal boolean, reasons string, action string"
    return spark.createDataFrame(log, columns), champion
