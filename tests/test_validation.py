import pytest
from pyspark.sql import functions as F

from conftest import booking, three_bookings
from roomtide.operators import cleaning, validation


def messages(df, **options):
    return validation.check(df.drop("seq"), record_only=True, **options)


def test_good_rows_pass(make_raw):
    assert messages(make_raw(three_bookings())) == []


@pytest.mark.parametrize(
    "change,expected",
    [
        ({"hotel": None}, ["hotel: 1 missing values"]),
        ({"is_canceled": 2}, ["is_canceled: 1 invalid binary values"]),
        ({"lead_time": -10}, ["lead_time: 1 negative values"]),
        ({"adr": float("nan")}, ["adr: 1 missing values"]),
        ({"adr": 6001.0}, ["adr: 1 values above maximum allowed value 6000"]),
        ({"arrival_date_month": "Januar"}, ["arrival_date_month: 1 invalid month values", "arrival_date: 1 invalid dates"]),
        ({"arrival_date_year": 2020}, ["arrival_date_year: 1 invalid year values"]),
        ({"adults": 0}, ["guest_count: 1 rows with zero guests"]),
        ({"meal": "XX"}, ["meal: 1 invalid category values"]),
        ({"children": None, "country": None, "agent": None}, []),
        (
            {"arrival_date_day_of_month": 32},
            ["arrival_date_day_of_month: 1 values above maximum allowed value 31", "arrival_date: 1 invalid dates"],
        ),
    ],
)
def test_one_bad_cell(make_raw, change, expected):
    assert messages(make_raw([*three_bookings(), booking(**change)])) == expected


def test_gate_raises_in_rule_order(make_raw):
    rows = make_raw([booking(lead_time=i) for i in range(10)])
    broken = cleaning.break_cells(rows, cleaning.BAD_CELLS, "seq").drop("seq")
    with pytest.raises(validation.ValidationFailed) as stopped:
        validation.check(broken)
    assert stopped.value.errors == [
        "is_canceled: 1 invalid binary values",
        "is_repeated_guest: 1 invalid binary values",
        "lead_time: 1 negative values",
        "adr: 1 negative values",
        "arrival_date_month: 1 invalid month values",
        "arrival_date: 1 invalid dates",
    ]


def test_columns_and_types(make_raw):
    raw = make_raw(three_bookings()).drop("seq", "meal").withColumn("extra", F.lit(1)).withColumn("adr", F.lit("x"))
    found = validation.check(raw, record_only=True)
    assert found[:3] == [
        "Missing columns: ['meal']",
        "Unexpected columns: ['extra']",
        "adr: expected numeric type, 3 values are not",
    ]
    assert "adr: expected numeric type, 3 values are not" in found
    clean = make_raw(three_bookings()).drop("seq").withColumn("row_id", F.lit(1))
    assert validation.check(clean, record_only=True) == ["Unexpected columns: ['row_id']"]
    assert validation.check(clean, allow_derived=True) == []


def test_missingness(make_raw):
    rows = make_raw([booking(children=None), booking(country=None, children=None)])
    found = {r["column"]: r.n_missing for r in validation.missingness(rows).collect()}
    assert found == {"children": 2, "country": 1, "company": 2}


def test_typed_schema(spark, make_raw):
    validation.check_typed(make_raw(three_bookings()))
    bad = spark.createDataFrame(
        [
            ("City Hotel", 2, 10, 2017, "July", 100.0, 0),
            ("Resort Hotel", 0, -5, 2016, "August", 120.0, 1),
            ("City Hotel", 1, 20, 2017, "Januar", 150.0, 0),
            ("Resort Hotel", 0, 30, 2016, "June", -50.0, 1),
            ("City Hotel", 1, 40, 2017, "May", 200.0, 3),
        ],
        "hotel string, is_canceled int, lead_time int, arrival_date_year int, arrival_date_month string, adr double, is_repeated_guest int",
    )
    with pytest.raises(validation.ValidationFailed) as stopped:
        validation.check_typed(bad)
    assert sorted(e.split(":")[0] for e in stopped.value.errors) == [
        "adr", "arrival_date_month", "is_canceled", "is_repeated_guest", "lead_time",
    ]
    with pytest.raises(validation.ValidationFailed, match="not of type float"):
        validation.check_typed(make_raw(three_bookings()).withColumn("adr", F.lit("1")))


def test_text_tables_are_judged_by_their_values(spark, make_raw):
    raw = make_raw(three_bookings() * 10).drop("seq")
    text = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])
    assert validation.check(text, record_only=True) == validation.check(raw, record_only=True) == []
    broken = text.withColumn("children", F.when(F.col("lead_time") == "10", "abc").when(F.col("lead_time") == "20", "7.5").otherwise(F.col("children")))
    broken = broken.withColumn("agent", F.lit("zzz")).withColumn("reservation_status_date", F.lit("2020-13-45"))
    errors = validation.check(broken, record_only=True)
    assert "children: expected numeric type, 10 values are not" in errors
    assert "children: 10 values are not whole numbers" in errors
    assert "agent: expected numeric type, 30 values are not" in errors
    assert "reservation_status_date: 30 invalid date values" in errors
    with pytest.raises(validation.ValidationFailed, match="agent"):
        validation.check(broken, record_only=True, stop_on=["data_type"])
