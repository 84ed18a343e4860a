from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from roomtide.operators import monitoring, occupancy, splitting
from roomtide.streaming import streams


def folder(frame, path):
    frame.repartition(3).write.parquet(str(path))
    return str(path)


def stream_of(spark, frame, path, files=None):
    return streams.read_table_stream(spark, folder(frame, path), frame.schema, files_per_trigger=files)


def test_weekly_stats_match_batch(spark, tmp_path):
    start = date(2017, 4, 1)
    rows = spark.createDataFrame([(start + timedelta(i % 40), i % 3 % 2) for i in range(300)], "arrival_date date, is_canceled int")
    stream = stream_of(spark, rows, tmp_path / "in")
    weekly = streams.weekly_stats_stream(stream, start, "60 days", "arrival_date")
    found = {r.week: (r.n_rows, round(r.cancel_rate, 4)) for r in streams.run_available(weekly, "w", ["week"]).collect()}
    batch = monitoring.weekly_stats(splitting.with_week(rows))
    assert found == {r.week: (r.n_rows, r.cancel_rate) for r in batch.collect()}


def test_occupancy_over_several_batches(spark, tmp_path):
    rows = spark.createDataFrame(
        [("H", date(2020, 1, 1) + timedelta(i % 20), 1 + i % 4, int(i % 5 == 0)) for i in range(200)],
        "hotel string, stay_date date, length_of_stay int, is_canceled int",
    )
    stream = streams.occupancy_stream(stream_of(spark, rows, tmp_path / "in", files=1), "60 days")
    found = streams.run_available(stream, "o", ["hotel", "night"])
    batch = occupancy.nightly_occupancy(rows).filter("occupancy > 0")
    assert {(r.night.date(), r.occupancy) for r in found.collect()} == {(r.date, r.occupancy) for r in batch.collect()}


def test_cooldown_state_lasts_between_batches(spark, tmp_path):
    path = tmp_path / "in"
    declared = "model string, week int, signal boolean"
    first = spark.createDataFrame([("m", w, w in (1, 3)) for w in (1, 2, 3)], declared)
    second = spark.createDataFrame([("m", w, w in (4, 5, 6)) for w in (4, 5, 6)], declared)
    first.coalesce(1).write.parquet(str(path))
    second.coalesce(1).write.mode("append").parquet(str(path))
    stream = streams.cooldown_stream(streams.read_table_stream(spark, str(path), first.schema, files_per_trigger=1))
    found = {r.week: r.action for r in streams.run_available(stream, "c").collect()}
    whole = monitoring.cooldown_actions(first.unionByName(second).withColumnRenamed("signal", "retrain"))
    assert found == {r.week: r.action for r in whole.collect()}


def test_late_labels_respect_the_time_bound(spark, tmp_path):
    t0 = datetime(2020, 1, 1)
    scores = spark.createDataFrame([(i, 0.5, t0) for i in range(3)], "row_id long, p double, score_ts timestamp")
    outcomes = spark.createDataFrame(
        [(0, 1, t0 + timedelta(3)), (1, 0, t0 + timedelta(90)), (7, 0, t0)], "row_id long, is_canceled int, outcome_ts timestamp"
    )
    joined = streams.late_labels_stream(stream_of(spark, scores, tmp_path / "s"), stream_of(spark, outcomes, tmp_path / "o"), "7 days")
    assert [(r.row_id, r.is_canceled) for r in streams.run_available(joined, "l").collect()] == [(0, 1)]


def test_sliding_levels(spark, tmp_path):
    t0 = datetime(2020, 1, 1)
    log = spark.createDataFrame([("/p", 200, 10.0 * i, t0 + timedelta(hours=6 * i)) for i in range(8)], "path string, status int, latency_ms double, ts timestamp")
    sliding = streams.service_levels_stream(stream_of(spark, log, tmp_path / "in"), "1 hour", "2 days", "1 day")
    found = {r.window_start.day: (r.requests, r.max_ms) for r in streams.run_available(sliding, "s", ["path", "window_start"]).collect()}
    assert found == {31: (4, 30.0), 1: (8, 70.0), 2: (4, 70.0)}


def test_quarantine_routes_rows(spark, make_raw, tmp_path):
    from conftest import booking

    rows = make_raw([booking(), booking(lead_time=-1), booking(adults=0)]).drop("seq")
    stream = stream_of(spark, rows, tmp_path / "in")
    streams.quarantine_stream(stream, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 1
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert sorted(r.f for r in bad.select(F.explode("problems.field").alias("f")).collect()) == ["guests", "lead_time"]


def shuffled_files(spark, path, rows=4000, files=8):
    """Events of 200 days in random order, one file per part."""
    t0 = datetime(2020, 1, 1)
    events = spark.range(rows).select(
        (F.lit(t0).cast("timestamp") + F.make_dt_interval(hours=(F.col("id") % 4800).cast("int"))).alias("ts"),
        F.when(F.col("id") % 3 == 0, "/a").otherwise("/b").alias("path"),
        F.when(F.col("id") % 7 == 0, 500).otherwise(200).alias("status"),
        (F.col("id") % 101).cast("double").alias("latency_ms"),
        (F.col("id") % 2).cast("int").alias("is_canceled"),
    )
    events.orderBy(F.xxhash64("ts", "path", "latency_ms")).repartition(files, F.xxhash64("latency_ms", "ts")).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_files_in_many_triggers_lose_nothing_or_raise(spark, tmp_path):
    rows = shuffled_files(spark, tmp_path / "in")
    stream = lambda: streams.read_table_stream(spark, str(tmp_path / "in"), rows.schema, files_per_trigger=1)
    start = date(2020, 1, 1)
    weekly = lambda delay: streams.run_available(streams.weekly_stats_stream(stream(), start, delay), "w", ["week"])
    levels = lambda delay: streams.run_available(streams.service_levels_stream(stream(), delay), "s", ["path", "window_start"])
    assert weekly("300 days").agg(F.sum("n_rows")).first()[0] == rows.count()
    found = {(r.path, r.window_start): (r.requests, r.server_errors_5xx, r.p50_ms, r.max_ms) for r in levels("300 days").collect()}
    batch = rows.groupBy("path", F.date_trunc("day", "ts").alias("d")).agg(
        F.count("*").alias("n"), F.count_if(F.col("status") >= 500).alias("e"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY latency_ms)").alias("m"), F.max("latency_ms").alias("x"),
    )
    assert found == {(r.path, r.d): (r.n, r.e, r.m, r.x) for r in batch.collect()}
    for run in (weekly, levels):
        with pytest.raises(streams.RowsTooLate):
            run("1 hour")


def stays_in_order(spark, n=120):
    rows = [("AB"[i % 2], date(2020, 1, 1) + timedelta(i // 3), 1 + i % 4, int(i % 5 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "hotel string, stay_date date, length_of_stay int, is_canceled int")


def test_active_list_equals_batch_and_forgets_guests(spark, tmp_path):
    rows = stays_in_order(spark)
    path = str(tmp_path / "in")
    stream = streams.feed_in_order(rows, path, "stay_date", files=4)
    for day in (date(2020, 6, 1), date(2020, 7, 1)):  # closes the feed; a second quiet day shows what is left
        spark.createDataFrame([(None, day, 0, 1)], rows.schema).coalesce(1).write.mode("append").parquet(path)
    reports = []
    found = streams.run_available(
        streams.active_list_stream(stream, "1 day"), "a", settings={"spark.sql.streaming.stateStore.providerClass": streams.ROCKSDB}, reports=reports
    )
    batch = occupancy.nightly_occupancy(rows)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, batch.select("hotel", "date", "occupancy").collect()))
    held = [sum(s.numRowsTotal for s in r.stateOperators) for r in reports if r.stateOperators]
    assert held[-1] < max(held) and held[-1] <= 6  # a level for each hotel is all that stays


def test_active_list_touches_its_state_once_a_batch_and_not_once_a_day():
    """One property, a year of stays: the calls of the state do not follow the number of days."""
    calls, held, timers = [], {}, set()

    class Value:
        def __init__(self, name):
            self.name = name

        exists = lambda self: calls.append("exists") or self.name in held
        get = lambda self: calls.append("get") or held[self.name]
        update = lambda self, row: calls.append("update") or held.update({self.name: row})
        clear = lambda self: calls.append("clear") or held.pop(self.name)

    class Handle:
        getValueState = lambda self, name, schema: Value(name)
        getMapState = lambda self, name, key, value: pytest.fail("an entry for every day")
        registerTimer = lambda self, at: calls.append("register") or timers.add(at)
        deleteTimer = lambda self, at: calls.append("delete") or timers.discard(at)

    class Times:
        def __init__(self, at):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: at

    lister = streams.ActiveList()
    lister.init(Handle())
    rows = pd.DataFrame({"day": [100 + i // 2 for i in range(700)], "nights": [1 + i % 5 for i in range(700)], "guests": [int(i % 7 > 0) for i in range(700)]})
    found = []
    for part, days, mark in ((rows[350:], 175, 150), (rows[:350], 175, 300), (rows[:0], 0, 1000)):  # the later half comes first
        list(lister.handleInputRows(("A",), iter([part]), Times(0)))
        while timers and min(timers) < mark * streams.DAY_MS:
            timers.discard(first := min(timers))
            times = Times(first)
            mark_at = Times(mark * streams.DAY_MS)
            for out in lister.handleExpiredTimer(("A",), mark_at, times):
                found += zip(out["date"], out["occupancy"])
    want = {}
    for day, nights, guests in rows[rows["guests"] > 0].itertuples(index=False):
        for d in range(day, day + nights):
            want[date(1970, 1, 1) + timedelta(d)] = want.get(date(1970, 1, 1) + timedelta(d), 0) + guests
    assert dict(found) == want and len(found) == len(want)
    assert len(calls) < 40 and not timers


def test_feed_reads_its_rows_as_often_however_many_files(spark, tmp_path, monkeypatch):
    """The files together hold every row with a time once, and are made from one dealt table."""
    rows = stays_in_order(spark).unionByName(spark.createDataFrame([("A", None, 1, 0)], stays_in_order(spark).schema))
    dealt = []
    monkeypatch.setattr(streams, "cut_lineage", lambda df, label="cut", by=None, plain=streams.cut_lineage: dealt.append(by) or plain(df, label, by))
    path = str(tmp_path / "in")
    streams.feed_in_order(rows.withColumn("_file", F.lit(7)), path, "stay_date", files=6)
    assert dealt == [None, ["_file_"]]
    back = spark.read.parquet(path)
    assert back.columns == [*rows.columns, "_file"] and back.where("_file = 7").count() == 120
    assert sorted(map(tuple, back.drop("_file").collect())) == sorted(tuple(r) for r in rows.collect() if r.stay_date)


def test_feed_comes_in_order_and_late_rows_raise(spark, tmp_path):
    rows = stays_in_order(spark)
    stream = streams.feed_in_order(rows, str(tmp_path / "in"), "stay_date", files=5)
    seen = []
    run = stream.writeStream.foreachBatch(lambda part, _: seen.append([r.stay_date for r in part.collect()])).trigger(availableNow=True)
    run.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    assert len(seen) == 5 and all(max(a) < min(b) for a, b in zip(seen, seen[1:])) and sum(map(len, seen)) == 120
    late = spark.createDataFrame([("A", date(2020, 1, 1), 1, 0)], rows.schema)
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    weekly = streams.weekly_stats_stream(stream, date(2020, 1, 1), "1 day", "stay_date")
    with pytest.raises(streams.RowsTooLate):
        streams.run_available(weekly, "w", ["week"])


def test_late_rows_are_kept_and_repaired(spark, tmp_path):
    day = datetime(2020, 1, 6)
    files = [[10, 11, 12], [1, 2, 30], [3, 29, 5, None], [31, 31, 10]]
    schema = "ts timestamp, is_canceled int, watermark_ string"
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    rows = []
    for k, days in enumerate(files):
        part = [(None if d is None else day + timedelta(days=d), (d or 0) % 2, "x") for d in days]
        rows += part
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    declared = spark.createDataFrame(rows, schema)
    stream = lambda: streams.read_table_stream(spark, source, declared.schema, files_per_trigger=1)
    streams.split_late(stream(), folder, "ts", "2 days", str(tmp_path / "state")).awaitTermination()
    late = streams.late_rows(spark, folder, declared.schema)
    got = sorted((r.batch, (r.ts - day).days if r.ts else None) for r in late.where("ts is not null").collect())
    assert got == [(1, 1), (1, 2), (2, 3), (2, 5), (3, 10)]
    counts = {r.batch: (r.rows_late, r.rows_without_time, r.seconds_behind) for r in streams.late_counts(late).collect()}
    assert counts == {1: (2, 0, 9 * 86400), 2: (3, 1, 25 * 86400), 3: (1, 0, 18 * 86400)}
    weekly = streams.weekly_stats_stream(streams.on_time_stream(spark, folder, declared.schema), day.date(), "2 days")
    found = streams.run_available(weekly, "weekly", ["week"])  # raises if it dropped a row
    batch = declared.where("ts is not null").groupBy((F.floor(F.datediff("ts", F.lit(day.date())) / 7) + 1).cast("int").alias("week"))
    want = {r.week: (r.n, pytest.approx(r.rate)) for r in batch.agg(F.count("*").alias("n"), F.avg("is_canceled").alias("rate")).collect()}
    repaired = {r.week: (r.n_rows, r.cancel_rate) for r in streams.repair_weeks(found, late, day.date()).collect()}
    assert repaired == want and len(found.collect()) < len(want)
    # nothing new: nothing is written again
    streams.split_late(stream(), folder, "ts", "2 days", str(tmp_path / "state")).awaitTermination()
    assert late.count() == 6
