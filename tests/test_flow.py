from datetime import date, timedelta

import pytest

from conftest import booking
from roomtide import schema
from roomtide.config import CostConfig
from roomtide.operators import models
from roomtide.operators.validation import ValidationFailed
from roomtide.plans import flow
from roomtide.sources import hashes
from test_sources import write_csv

FEATURES = ["lead_time", "adr"]


@pytest.fixture(scope="module")
def raw_path(tmp_path_factory):
    rows = []
    for i in range(2400):
        day = date(2015, 7, 1) + timedelta(i * 760 // 2400)
        rows.append(
            booking(
                hotel=schema.DOMAINS["hotel"][i % 2], lead_time=i % 150, adr=60.0 + i % 70, is_canceled=int((i * 7919) % 100 < 15 + (i % 150) // 3),
                arrival_date_year=day.year, arrival_date_month=schema.MONTHS[day.month - 1], arrival_date_day_of_month=day.day,
                arrival_date_week_number=day.isocalendar()[1], reservation_status_date=day, agent=i % 5, total_of_special_requests=i % 4,
            )
        )
    rows[5] = booking(adr=-3.0)
    return write_csv(tmp_path_factory.mktemp("raw") / "bookings.csv", rows)



@pytest.fixture(scope="module")
def prepared(spark, raw_path, tmp_path_factory):
    mark = hashes.file_checksums(spark, raw_path).first().sha256
    out = str(tmp_path_factory.mktemp("out"))
    return flow.prepare_data(spark, raw_path, out, order_by="arrival_date", sha256=mark, tie_break="lead_time"), out


@pytest.fixture(scope="module")
def trained(spark, prepared):
    splits = spark.read.parquet(prepared[0].split_path)
    return models.train_calibrated(splits, models.random_forest(5, 4, 10))[0]


def test_prepared_tables(spark, prepared):
    found, out = prepared
    assert found.raw_errors == ["adr: 1 negative values"]
    assert spark.read.parquet(found.clean_path).count() == 2399
    sizes = {r.split: r["count"] for r in spark.read.parquet(found.split_path).groupBy("split").count().collect()}
    assert sum(sizes.values()) == 2399 and set(sizes) == set(schema.SPLITS)
    assert spark.read.json(f"{out}/manifest").first().splits.train.rows == sizes["train"]
    assert spark.read.parquet(f"{out}/rate_by_month_hotel").count() == 24
    assert spark.read.parquet(f"{out}/split_comparison").count() == 4


def test_bad_clean_table_stops_the_flow(spark, tmp_path):
    path = write_csv(tmp_path / "bad.csv", [booking(lead_time=i, meal="XX") for i in range(5)])
    with pytest.raises(ValidationFailed, match="invalid category"):
        flow.prepare_data(spark, path, str(tmp_path / "out"), order_by="lead_time")


def test_decision(spark, prepared, trained, tmp_path):
    splits = spark.read.parquet(prepared[0].split_path)
    rows = flow.decision_dataset(splits.filter("split = 'test'").drop("split"), trained)
    assert rows.columns == ["row_id", "hotel", "stay_date", "adr", "is_canceled", "lead_time", "length_of_stay", "p_cancel"]
    config = CostConfig(capacity={"City Hotel": 5, "Resort Hotel": 4})
    summary = flow.decide(rows, config, str(tmp_path / "d")).collect()
    assert len(summary) == 4 and summary[0].n_nights == summary[1].n_nights
    assert spark.read.parquet(str(tmp_path / "d/sensitivity")).count() == 12


def test_replay(spark, prepared, trained):
    splits = spark.read.parquet(prepared[0].split_path)
    rows = flow.replay_production(splits, trained, drift_features=FEATURES, max_weeks=6).collect()
    assert [r.week for r in rows] == [1, 2, 3, 4, 5, 6]
    quiet = flow.replay_production(splits, None, drift_features=FEATURES, max_weeks=2).collect()
    assert all("performance" not in r.reasons for r in quiet)


def test_replay_with_retraining(spark, prepared, trained):
    splits = spark.read.parquet(prepared[0].split_path)
    clean = spark.read.parquet(prepared[0].clean_path)
    config = CostConfig(capacity={"City Hotel": 5, "Resort Hotel": 4})
    log, _ = flow.replay_with_retraining(
        clean, splits, trained, config, max_weeks=3, classifier=models.random_forest(3, 3, 10), drift_features=FEATURES
    )
    rows = log.collect()
    assert [r.week for r in rows] == [1, 2, 3]
    acted = [r for r in rows if r.action.startswith("retrain")]
    assert len(acted) <= 1
    if acted:
        assert all(r.action.startswith("skipped") for r in rows if r.week > acted[0].week and r.retrain_signal)


def test_window_gate_without_champion(spark, prepared):
    clean = spark.read.parquet(prepared[0].clean_path)
    _, gate = flow.retrain(clean, date(2017, 6, 1), None, CostConfig(), models.random_forest(3, 3, 10))
    found = gate.first()
    assert found.champion is None and found.profit is None and found.cutoff == "2017-06-01"
    assert found.passed == (found.candidate.ece <= 0.05)
