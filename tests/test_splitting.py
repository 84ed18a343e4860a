from datetime import date

import pytest
from pyspark.sql import functions as F

from roomtide.operators import monitoring, splitting


@pytest.fixture(scope="module")
def monthly(spark):
    days = [date(2020 + m // 12, m % 12 + 1, 1) for m in range(30)]
    return spark.createDataFrame([(d, i % 2) for i, d in enumerate(days)], "arrival_date date, is_canceled int")


def test_sizes_and_integrity(monthly):
    split = splitting.temporal_split(monthly)
    stats = {r.split: r.n_rows for r in splitting.split_stats(split).collect()}
    assert stats == {"train": 12, "validation": 6, "test": 3, "production": 9}
    splitting.check_split(monthly, split)
    assert splitting.lost_rows(monthly, split, monthly.columns).count() == 0


def test_lost_row(monthly):
    split = splitting.temporal_split(monthly).filter("arrival_date <> date'2022-06-01'")
    with pytest.raises(splitting.SplitError, match="29 of 30"):
        splitting.check_split(monthly, split)


def test_missing_day_has_no_split(spark, monthly):
    rows = monthly.unionByName(spark.createDataFrame([(None, 0)], monthly.schema))
    with pytest.raises(splitting.SplitError, match="30 of 31"):
        splitting.check_split(rows, splitting.temporal_split(rows))


def test_overlap_and_empty_split(monthly):
    split = splitting.temporal_split(monthly)
    same = split.filter("split = 'train'").limit(1).withColumn("split", F.lit("test"))
    moved = split.filter("arrival_date <> date'2021-07-01'").unionByName(same)
    with pytest.raises(splitting.SplitError, match="train and test"):
        splitting.check_split(monthly, moved)
    order = {(r.earlier, r.later): r.in_order for r in splitting.split_order(split.filter("split <> 'test'")).collect()}
    assert order == {("train", "validation"): True, ("validation", "test"): False, ("test", "production"): False}


def test_no_day_column(monthly):
    with pytest.raises(splitting.SplitError, match="arrival_date"):
        splitting.temporal_split(monthly.drop("arrival_date"))


def test_limits_reach_the_scan(monthly, tmp_path):
    monthly.write.parquet(str(tmp_path / "m"))
    stored = monthly.sparkSession.read.parquet(str(tmp_path / "m"))
    window = splitting.retrain_window(stored, date(2022, 1, 31), check=False)
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(arrival_date), GreaterThanOrEqual(arrival_date,2020-04-30)" in plan


def test_retrain_window(monthly):
    window = splitting.retrain_window(monthly, date(2022, 1, 1))
    stats = {r.split: (r.n_rows, r.start_date, r.end_date) for r in splitting.split_stats(window).collect()}
    assert stats["train"] == (12, date(2020, 4, 1), date(2021, 3, 1))
    assert stats["validation"] == (6, date(2021, 4, 1), date(2021, 9, 1))
    assert stats["test"] == (3, date(2021, 10, 1), date(2021, 12, 1))
    with pytest.raises(splitting.SplitError, match="too early"):
        splitting.retrain_window(monthly, date(2020, 2, 1))


def test_weeks(spark):
    days = [date(2017, 4, 1), date(2017, 4, 7), date(2017, 4, 8), date(2017, 4, 30)]
    rows = spark.createDataFrame([(d, i % 2) for i, d in enumerate(days)], "arrival_date date, is_canceled int")
    weeks = splitting.with_week(rows)
    assert [r.week for r in weeks.orderBy("arrival_date").collect()] == [1, 1, 2, 5]
    first = monitoring.weekly_stats(weeks).orderBy("week").first()
    assert (first.n_rows, first.cancel_rate, first.cutoff) == (2, 0.5, date(2017, 4, 8))
    assert sorted(r.week for r in monitoring.first_weeks(weeks, 2).select("week").distinct().collect()) == [1, 2]


def test_manifest_is_one_document(monthly):
    document = splitting.manifest(splitting.temporal_split(monthly)).first()
    assert document.train_months == 12 and set(document.splits) == {"train", "validation", "test", "production"}
    assert document.splits["train"].rows == 12 and document.splits["train"].fingerprint
