import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.config import CostConfig
from roomtide.operators import drift, monitoring, records, service_levels


def test_cooldown(spark):
    signals = spark.createDataFrame(
        [(w, w in (1, 3, 5, 6, 9)) for w in range(1, 11)], "week int, retrain boolean"
    ).repartition(3)
    found = {r.week: r.action for r in monitoring.cooldown_actions(signals).collect()}
    assert [w for w, a in found.items() if a == monitoring.DRY_RUN] == [1, 5, 9]
    assert found[3] == "skipped (cooldown until week 5)" and found[6] == "skipped (cooldown until week 9)"
    assert found[2] == "-"


def test_prior_shift_is_strict(spark):
    reference = spark.createDataFrame([(0,), (1,)], "is_canceled int")
    current = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1)], "week int, is_canceled int")
    found = {r.week: (r.absolute_gap, r.triggered) for r in drift.prior_shift(reference, current, keys=["week"], limit=0.5).collect()}
    assert found == {1: (0.0, False), 2: (0.5, False)}


def test_js_psi_ks(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=3000), rng.normal(0.5, 1.2, 2000)
    reference = spark.createDataFrame([(float(x),) for x in a], "x double")
    current = spark.createDataFrame([(float(x), 1, 0) for x in b] + [(None, 1, 0)], "x double, week int, chunk int")
    edges = np.unique(np.quantile(a, np.arange(1, 10) / 10))
    p = np.bincount((a[:, None] > edges).sum(1), minlength=10) / len(a)
    q = np.bincount((b[:, None] > edges).sum(1), minlength=10) / len(b)
    m = (p + q) / 2
    js = np.sqrt((p * np.log2(p / m) + q * np.log2(q / m)).sum() / 2)
    found = drift.data_drift(reference, current, ["x"]).first()
    assert found.js_distance == pytest.approx(js, abs=1e-9) and found.alert == (js > 0.1)
    for per_range in (200, 1_000_000):
        row = drift.column_drift(reference, current, ["x"], rows_per_range=per_range).first()
        grid = np.unique(np.concatenate([a, b]))
        gap = np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b))
        assert row.psi == pytest.approx(((q - p) * np.log(q / p)).sum(), abs=1e-9)
        assert row.ks == pytest.approx(gap.max(), abs=1e-9)
        assert row.wasserstein_normed == pytest.approx((gap[:-1] * np.diff(grid)).sum() / a.std(), abs=1e-9)


def test_chunks(spark):
    rows = spark.range(1300).select("id", F.when(F.col("id") < 1100, 1).otherwise(2).alias("week"), (F.col("id") / 10).cast("int").alias("t"))
    for per_range in (100, 10_000):
        chunked = drift.with_chunks(rows.repartition(4), "week", "t", "id", rows_per_range=per_range)
        sizes = {(r.week, r.chunk): r["count"] for r in chunked.groupBy("week", "chunk").count().collect()}
        assert sizes == {(1, 0): 500, (1, 1): 500, (1, 2): 100, (2, 0): 200}


def scored(spark, alias, p, y):
    return spark.createDataFrame([(alias, int(b), float(a)) for a, b in zip(p, y)], "alias string, y int, p double")


def test_performance_drift_and_decision(spark):
    good = scored(spark, "x", [0.0, 0.0, 1.0, 1.0], [0, 0, 1, 1])
    bad = scored(spark, "x", [1.0, 0.0, 0.0, 1.0], [0, 0, 1, 1]).withColumn("week", F.lit(1))
    found = drift.performance_drift(good, bad)
    row = found.first()
    assert row.reasons == [
        f"Concept/performance drift: PR-AUC dropped by {1 - row.pr_auc:.4f} (>0.03)",
        f"Concept/performance drift: ECE {row.ece:.4f} >0.05",
    ]
    prior = drift.prior_shift(good.withColumnRenamed("y", "is_canceled"), bad.withColumnRenamed("y", "is_canceled"), keys=["week"])
    alerts = spark.createDataFrame([(1, 2)], "week int, n_alerts long")
    decision = monitoring.retrain_decision(alerts, prior, found).first()
    assert decision.retrain and decision.reasons == ["Data drift detected 2 drift alert(s)", *row.reasons]
    missing = drift.performance_drift(None, bad)
    assert not missing.first().available
    none = monitoring.retrain_decision(alerts.withColumn("n_alerts", F.lit(0).cast("long")), prior, missing).first()
    assert not none.retrain and none.reasons == []


def test_gate(spark):
    p, y = [0.1] * 10 + [0.9] * 10, [0] * 9 + [1] + [1] * 9 + [0]
    both = scored(spark, "candidate", p, y).unionByName(scored(spark, "champion", p, y))
    profits = spark.createDataFrame([("candidate", 10.0), ("champion", 10.0)], "alias string, profit double")
    passed = monitoring.promotion_gate(both, profits, "2017-05-14").first()
    assert passed.passed and passed.reasons == [] and passed.profit.delta == 0.0 and passed.candidate == passed.champion
    poorer = profits.withColumn("profit", F.when(F.col("alias") == "candidate", 9.0).otherwise(10.0))
    assert monitoring.promotion_gate(both, poorer).first().reasons == ["profit 9.0 is below champion 10.0"]
    worse = scored(spark, "candidate", [0.6] * 20, y).unionByName(scored(spark, "champion", p, y))
    reasons = monitoring.promotion_gate(worse, profits).first().reasons
    assert [r.split()[0] for r in reasons] == ["ECE", "PR-AUC"]
    alone = monitoring.promotion_gate(scored(spark, "candidate", p, y)).first()
    assert alone.passed and alone.champion is None and alone.profit is None
    with pytest.raises(Exception, match="no candidate"):
        monitoring.promotion_gate(scored(spark, "champion", p, y)).collect()


def test_missing_columns(spark):
    frame = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="Missing required columns: b, c"):
        drift.check_columns({"x": frame}, ["a", "c", "b"])


def test_service_levels(spark):
    log = spark.range(3000).select(
        F.timestamp_seconds(F.col("id")).alias("ts"), "id",
        F.when(F.col("id") % 10 == 0, "/health").when(F.col("id") % 97 == 0, "/metrics").otherwise("/predict").alias("path"),
        F.when(F.col("id") % 100 == 1, 500).when(F.col("id") % 50 == 2, 422).otherwise(200).alias("status"),
        F.col("id").cast("double").alias("latency_ms"),
    )
    levels = {r.path: r for r in service_levels.latency_by_path(log).collect()}
    assert set(levels) == {"/health", "/predict"}
    kept = sorted(i for i in range(3000) if i % 10 and i % 97)[-1000:]
    predict = levels["/predict"]
    assert (predict["count"], predict.max_ms, predict.requests) == (1000, 2999.0, sum(1 for i in range(3000) if i % 10 and i % 97))
    assert predict.p95_ms == pytest.approx(np.percentile(kept, 95), abs=0.01)
    totals = service_levels.service_totals(log).first()
    assert totals.server_errors_5xx > 0 and totals.error_rate == round(totals.server_errors_5xx / totals.total_requests, 4)
    assert totals.error_rate_ok == (totals.server_errors_5xx / totals.total_requests <= 0.01)


def request(**changes):
    base = dict(
        hotel="City Hotel", lead_time=120, arrival_date_year=2017, arrival_date_month="July", arrival_date_week_number=28,
        arrival_date_day_of_month=12, stays_in_weekend_nights=1, stays_in_week_nights=2, adults=2, meal="BB",
        market_segment="Online TA", distribution_channel="TA/TO", is_repeated_guest=0, reserved_room_type="A",
        deposit_type="No Deposit", customer_type="Transient", adr=110.5, agent=9, company=None, country=None,
    )
    return {**base, **changes}


@pytest.mark.parametrize(
    "change,fields",
    [
        ({}, []),
        ({"adults": 0}, ["guests"]),
        ({"lead_time": -5}, ["lead_time"]),
        ({"adr": -10.0}, ["adr"]),
        ({"arrival_date_month": "Julyy"}, ["arrival_date_month"]),
        ({"hotel": "Beach Hotel"}, ["hotel"]),
        ({"lead_time": None}, ["lead_time"]),
        ({"deposit_type": "Cash", "is_repeated_guest": 2}, ["is_repeated_guest", "deposit_type"]),
    ],
)
def test_record_problems(spark, change, fields):
    row = request(**change)
    names = [n for n in records.BOOKING_FIELDS if n in row]
    kinds = ", ".join(f"{n} {records.BOOKING_FIELDS[n].kind.simpleString()}" for n in names)
    sent = spark.createDataFrame([tuple(row[n] for n in names)], kinds)
    checked = records.find_problems(records.apply_defaults(sent))
    assert [p.field for p in checked.first().problems] == fields
    assert records.valid_rows(checked).count() == (0 if fields else 1)


def test_request_groups(spark):
    rows = [
        (1, "City Hotel", "City Hotel", 10), (1, "City Hotel", "City Hotel", 10),
        (2, "City Hotel", "Resort Hotel", 10), (3, "City Hotel", "City Hotel", None),
        (4, "City Hotel", "City Hotel", 999), (5, "City Hotel", None, 0),
    ] + [(6, "City Hotel", "City Hotel", 1)] * 1001
    frame = spark.createDataFrame(rows, "request_id int, request_hotel string, hotel string, already_occupied int")
    checked = records.check_requests(frame, CostConfig())
    found = {r.request_id: [p.field for p in r.problems] for r in checked.collect()}
    assert found == {1: [], 2: ["hotel"], 3: ["already_occupied"], 4: ["already_occupied"], 5: ["bookings"], 6: ["bookings"]}
