"""Streaming forms of the weekly, validation, scoring and occupancy operators.

Event time drives every window and join; state is dropped once the watermark has passed.
Sinks are keyed by batch number, so a batch that is replayed after a failure overwrites
its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roomtide.operators.models import CalibratedModel
from roomtide.operators.monitoring import COOLDOWN_WEEKS, DRY_RUN, NO_ACTION
from roomtide.operators.ranking import free_names
from roomtide.operators.records import find_problems, rejected_rows, valid_rows
from roomtide.session import cut_lineage, shared_path


def read_table_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, with a declared schema."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def feed_in_order(df: DataFrame, folder: str, ts: str, files: int = 8, rows_per_file: int = 1_000_000) -> DataFrame:
    """Write ``df`` as files that follow one another in event time, as a feed delivers them, and return them as a stream.

    No value of ``ts`` is split between files, and every trigger takes one file; more rows make more files.
    The rows are dealt to the files in one pass, so each is read as often whatever the number of files.
    """
    spark = df.sparkSession
    rows = cut_lineage(df, "feed")
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    files = max(files, -(-rows.count() // rows_per_file))
    shares = [i / files for i in range(1, files)]
    cuts = rows.select(F.approx_percentile(at, shares, 100 * files).alias("cuts")).first().cuts or []
    edges = sorted(set(cuts))
    (number,) = free_names(rows, "_file")
    if edges:  # the file of a row: how many edges lie before its time; rows without a time are in none
        before = F.filter(F.array(*[F.lit(e) for e in edges]), lambda edge: edge < F.col(number))
        rows = rows.withColumn(number, at).where(F.col(number).isNotNull()).withColumn(number, F.size(before))
    else:
        rows = rows.withColumn(number, F.lit(0))
    dealt = cut_lineage(rows, "dealt", [number])
    for k in range(len(edges) + 1):
        dealt.where(F.col(number) == k).drop(number).coalesce(1).write.mode("append").parquet(folder)
    return read_table_stream(spark, folder, df.schema, files_per_trigger=1)


# --- Windowed aggregates ----------------------------------------------------


def week_offset(first_day: date) -> str:
    """Window offset that makes weeks start on the weekday of ``first_day``."""
    return f"{(first_day - date(1970, 1, 1)).days % 7} days"


def weekly_stats_stream(
    stream: DataFrame, first_day: date, delay: str, ts: str = "ts", label: str = "is_canceled"
) -> DataFrame:
    """Rows and label rate per week, numbered from the week of ``first_day``.

    ``delay`` is how late a row may come; see :func:`run_available` for what happens beyond it.
    """
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    weekly = timed.groupBy(F.window("_ts", "7 days", "7 days", week_offset(first_day)))
    found = weekly.agg(F.count("*").alias("n_rows"), F.avg(label).alias("cancel_rate"))
    week = F.floor(F.datediff(F.col("window.start").cast("date"), F.lit(first_day)) / 7) + 1
    return found.select(week.cast("int").alias("week"), "n_rows", "cancel_rate")


def service_levels_stream(
    log: DataFrame, delay: str, width: str = "1 day", slide: str | None = None, accuracy: int = 10_000
) -> DataFrame:
    """Requests, server errors and latency per path and window; sliding when ``slide`` is given.

    Percentiles come from a sketch of bounded size, so a busy path does not grow the state.
    """
    timed = log.withColumn("_ts", F.col("ts").cast("timestamp")).withWatermark("_ts", delay)
    window = F.window("_ts", width, slide) if slide else F.window("_ts", width)
    levels = F.approx_percentile("latency_ms", F.array(F.lit(0.5), F.lit(0.95)), accuracy)
    found = timed.groupBy("path", window).agg(
        F.count("*").alias("requests"),
        F.count_if(F.col("status") >= 500).alias("server_errors_5xx"),
        levels.alias("_levels"),
        F.max("latency_ms").alias("max_ms"),
    )
    return found.select(
        "path",
        F.col("window.start").alias("window_start"),
        "requests",
        "server_errors_5xx",
        F.col("_levels")[0].alias("p50_ms"),
        F.col("_levels")[1].alias("p95_ms"),
        "max_ms",
    )


def occupancy_stream(
    stream: DataFrame,
    delay: str,
    hotel: str = "hotel",
    stay: str = "stay_date",
    nights: str = "length_of_stay",
    canceled: str = "is_canceled",
) -> DataFrame:
    """Rooms taken per hotel and night, updated as bookings arrive."""
    kept = stream.filter(F.col(canceled) == 0)
    day = F.col(stay).cast("date")
    taken = kept.select(
        F.col(hotel).alias("hotel"), F.explode(F.sequence(day, F.date_add(day, F.col(nights) - 1))).alias("date")
    )
    timed = taken.withColumn("night", F.col("date").cast("timestamp")).withWatermark("night", delay)
    return timed.groupBy("hotel", "night").agg(F.count("*").alias("occupancy"))


DAY_MS = 86_400_000


class ActiveList(StatefulProcessor):
    """Guests of a property between check-in and checkout.

    The state is the level reached so far and, in one value, the change of guests on each of the days to
    come, which goes when there are none. One timer stands at the earliest of them. When the watermark has passed it nobody
    else can arrive on the days behind: the nights before them are returned together and their guests
    leave the state. What stays is the span of the longest stay, and a property is read and written
    once or twice a batch, whatever the number of its days.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.moves = handle.getValueState("moves", "days array<int>, nets array<bigint>")  # in order of the day
        self.level = handle.getValueState("level", "day int, guests bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        change: dict[int, int] = {}
        for part in rows:
            part = part[part["guests"] > 0]
            for day, nights, guests in zip(part["day"].tolist(), part["nights"].tolist(), part["guests"].tolist()):
                change[day] = change.get(day, 0) + guests
                change[day + nights] = change.get(day + nights, 0) - guests
        if change:
            days, nets = self.moves.get() if self.moves.exists() else ([], [])
            for day, net in zip(days, nets):
                change[day] = change.get(day, 0) + net
            order = sorted(change)
            self.moves.update((order, [change[day] for day in order]))
            if not days or order[0] != days[0]:
                if days:
                    self.handle.deleteTimer(days[0] * DAY_MS)
                self.handle.registerTimer(order[0] * DAY_MS)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fired, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        days, nets = self.moves.get()
        before, guests = self.level.get() if self.level.exists() else (days[0], 0)
        nights, counts, passed = [], [], 0
        for day, net in zip(days, nets):
            if day * DAY_MS > fired and day * DAY_MS >= watermark:
                break
            nights += range(before, day)
            counts += [guests] * (day - before)
            before, guests, passed = day, guests + net, passed + 1
        self.level.update((before, guests))
        if passed < len(days):
            self.moves.update((list(days[passed:]), list(nets[passed:])))
            self.handle.registerTimer(days[passed] * DAY_MS)
        else:
            self.moves.clear()
        if nights:
            dates = [date.fromordinal(EPOCH_DAY + d) for d in nights]
            yield pd.DataFrame({"hotel": key[0], "date": dates, "occupancy": counts})


EPOCH_DAY = date(1970, 1, 1).toordinal()


def active_list_stream(
    stream: DataFrame,
    delay: str,
    hotel: str = "hotel",
    stay: str = "stay_date",
    nights: str = "length_of_stay",
    canceled: str = "is_canceled",
) -> DataFrame:
    """Rooms taken per hotel and night, returned once per night when the watermark has passed it.

    Needs the RocksDB state store; a row behind the watermark is late, see :func:`run_available`.
    Canceled bookings move the watermark on but never enter the state.
    """
    guests = F.when((F.col(canceled) == 0) & (F.col(nights) > 0), 1).otherwise(0)
    day = F.col(stay).cast("date")
    slim = stream.select(
        F.col(hotel).alias("hotel"), day.cast("timestamp").alias("ts"), F.unix_date(day).alias("day"),
        F.col(nights).cast("int").alias("nights"), guests.alias("guests"),
    )
    keyed = slim.withWatermark("ts", delay).groupBy("hotel")
    return keyed.transformWithStateInPandas(
        ActiveList(), "hotel string, date date, occupancy bigint", outputMode="append", timeMode="eventTime"
    )


# --- Records, scores and late labels ----------------------------------------


def quarantine_stream(stream: DataFrame, valid_path: str, rejected_path: str, checkpoint: str, once: bool = True):
    """Check records as they arrive and write valid and rejected ones to two tables."""

    def route(batch: DataFrame, number: int) -> None:
        checked = find_problems(batch).persist()
        try:
            valid_rows(checked).write.mode("overwrite").parquet(f"{valid_path}/batch={number}")
            rejected_rows(checked).write.mode("overwrite").parquet(f"{rejected_path}/batch={number}")
        finally:
            checked.unpersist()

    writer = stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def score_stream(
    model: CalibratedModel, stream: DataFrame, features: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Stateless scoring with the same features and model as the batch form."""
    return model.score(features(stream) if features else stream)


def late_labels_stream(
    scores: DataFrame,
    outcomes: DataFrame,
    delay: str,
    key: str = "row_id",
    score_ts: str = "score_ts",
    outcome_ts: str = "outcome_ts",
    within: str = "60 days",
) -> DataFrame:
    """Scores joined to the outcomes that become known later, within a bounded time."""
    left = scores.withWatermark(score_ts, delay)
    right = outcomes.withColumnRenamed(key, "_key").withWatermark(outcome_ts, delay)
    in_time = (F.col(outcome_ts) >= F.col(score_ts)) & (F.col(outcome_ts) <= F.col(score_ts) + F.expr(f"INTERVAL {within}"))
    return left.join(right, (F.col(key) == F.col("_key")) & in_time).drop("_key")


# --- Rows behind the watermark ------------------------------------------------


def split_late(stream: DataFrame, folder: str, ts: str, delay: str, checkpoint: str, once: bool = True):
    """Deal the rows of a stream to ``folder/on_time`` and ``folder/late``, so that a later stream loses none.

    The watermark of a batch is the newest event time of all earlier batches less ``delay``. It comes
    from ``folder/marks``, where every batch leaves its newest time, so a batch that is replayed
    after a failure decides alike and overwrites its own output. Late rows have two more columns:
    ``watermark`` and ``batch``; rows without an event time are late rows too, as no window takes them.

    On-time rows of a batch are one file (a batch is as large as a trigger allows): a stream that
    takes a file a trigger then has a watermark no later than that of the batch.
    """
    spark = stream.sparkSession
    at = F.col(ts).cast("timestamp")
    marks = T.StructType([T.StructField("newest", T.TimestampType()), T.StructField("batch", T.LongType())])

    def deal(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            held.agg(F.max(at).alias("newest")).write.mode("overwrite").parquet(f"{folder}/marks/batch={number}")
            before = spark.read.schema(marks).parquet(f"{folder}/marks").where(F.col("batch") < number)
            limit = before.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).cast("string").alias("w")).first().w  # one value
            watermark = F.lit(limit).cast("timestamp")
            late = at.isNull() | F.coalesce(at < watermark, F.lit(False))
            held.where(~late).coalesce(1).write.mode("overwrite").parquet(f"{folder}/on_time/batch={number}")
            held.where(late).withColumn("watermark", watermark).write.mode("overwrite").parquet(f"{folder}/late/batch={number}")
        finally:
            held.unpersist()

    writer = stream.writeStream.foreachBatch(deal).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def on_time_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return read_table_stream(spark, f"{folder}/on_time/*", schema, files_per_trigger=1)


def late_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The side table: late rows with the watermark they met and the number of their batch."""
    more = [T.StructField("watermark", T.TimestampType()), T.StructField("batch", T.LongType())]
    return spark.read.schema(T.StructType([*schema.fields, *more])).parquet(f"{folder}/late")


def late_counts(late: DataFrame, ts: str = "ts") -> DataFrame:
    """batch, rows_late, rows_without_time and the seconds by which the latest row came too late."""
    behind = F.unix_seconds("watermark") - F.unix_seconds(F.col(ts).cast("timestamp"))
    return late.groupBy("batch").agg(
        F.count("*").alias("rows_late"), F.count_if(F.col(ts).isNull()).alias("rows_without_time"), F.max(behind).alias("seconds_behind")
    )


def repair_weeks(weekly: DataFrame, late: DataFrame, first_day: date, ts: str = "ts", label: str = "is_canceled") -> DataFrame:
    """Weekly statistics of a stream with the late rows added, as if every row had come in time.

    Only late rows are read again; weeks that had none stay as they are. A label that is null does
    not count in the rate, so the table of the stream must have ``n_labels`` where labels can be null.
    """
    number = F.floor(F.datediff(F.col(ts).cast("date"), F.lit(first_day)) / 7) + 1
    more = late.where(F.col(ts).isNotNull()).groupBy(number.cast("int").alias("week"))
    more = more.agg(F.count("*").alias("n_rows"), F.count(label).alias("n_labels"), F.sum(F.col(label).cast("double")).alias("total"))
    known = F.col("n_labels") if "n_labels" in weekly.columns else F.col("n_rows")
    have = weekly.select("week", "n_rows", known.alias("n_labels"), (F.col("cancel_rate") * known).alias("total"))
    merged = have.unionByName(more).groupBy("week").agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_labels", "total")])
    return merged.select("week", "n_rows", F.when(F.col("n_labels") > 0, F.col("total") / F.col("n_labels")).alias("cancel_rate"))


# --- Cooldown ---------------------------------------------------------------

ACTION_SCHEMA = "model string, week int, action string"


def cooldown_stream(signals: DataFrame, cooldown: int = COOLDOWN_WEEKS, acted: str = DRY_RUN) -> DataFrame:
    """Action per model and week; the state of a model is the week of its last action.

    ``signals`` has ``(model, week, signal)``. Weeks of a batch are taken in order.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        weeks = pd.concat(list(parts)).sort_values("week")
        actions = []
        for week, signal in zip(weeks["week"], weeks["signal"]):
            if not signal:
                actions.append(NO_ACTION)
            elif last is not None and week - last < cooldown:
                actions.append(f"skipped (cooldown until week {last + cooldown})")
            else:
                actions.append(acted)
                last = int(week)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({"model": key[0], "week": weeks["week"].astype("int32"), "action": actions})

    slim = signals.select(F.col("model"), F.col("week").cast("int").alias("week"), F.coalesce("signal", F.lit(False)).alias("signal"))
    return slim.groupBy("model").applyInPandasWithState(step, ACTION_SCHEMA, "last int", "append", GroupStateTimeout.NoTimeout)


# --- Running a stream to completion -----------------------------------------


class RowsTooLate(RuntimeError):
    """Rows came later than the watermark allows, so the result would lack them."""


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(
    stream: DataFrame,
    label: str,
    keys: Sequence[str] = (),
    mode: str | None = None,
    settings: Mapping[str, str] | None = None,
    reports: list | None = None,
) -> DataFrame:
    """Process what is there and return the resulting table from the shared folder.

    ``settings`` hold for this stream only; ``reports`` takes the progress report of every batch.

    With ``keys`` the stream emits updates and the newest row per key counts. Raises
    :class:`RowsTooLate` when a batch reports rows behind the watermark: nothing is lost silently.
    """
    spark = stream.sparkSession
    path, checkpoint = shared_path(spark, label), shared_path(spark, f"{label}-state")

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(store).outputMode(mode or ("update" if keys else "append"))
    wanted = {"spark.sql.streaming.numRecentProgressUpdates": "1000000", **(settings or {})}  # the report of every batch
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        run = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
        late = sum(state.numRowsDroppedByWatermark for report in run.recentProgress for state in report.stateOperators)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    if reports is not None:
        reports.extend(run.recentProgress)
    if late:
        raise RowsTooLate(f"{late} rows or partial sums of {label} came behind the watermark; allow a longer delay")
    declared = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(declared).parquet(path)
    if not keys:
        return rows.drop("batch")
    others: list[Column] = [F.max_by(c, "batch").alias(c) for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(*others)
