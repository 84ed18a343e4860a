from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.functions import binning, columns
from roomtide.operators.splitting import add_months


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


def test_half_even(spark):
    rows = spark.createDataFrame([(10.5,), (11.5,), (0.5,), (2.4,), (-1.5,)], "x double")
    assert [r.v for r in rows.select(columns.half_even("x").alias("v")).collect()] == [10, 12, 0, 2, -2]


def test_bins_close_opposite_edges(spark):
    scores = [0.0, 0.1, 0.2, 0.3, 0.6, 0.7, 1.0]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(scores)], "i int, p double").orderBy("i")
    found = rows.select(binning.calibration_error_bin("p").alias("e"), binning.reliability_bin("p").alias("r")).collect()
    assert [r.e for r in found] == [0, 1, 2, 2, 5, 6, 9]
    assert [r.r for r in found] == [0, 0, 1, 2, 5, 6, 9]
    assert binning.inner_edges(10) == np.linspace(0, 1, 11)[1:-1].tolist()


def test_arrival_date_forms(spark):
    lenient = columns.arrival_date(F.lit(2016), F.lit("February"), F.lit(30), strict=False)
    assert one(spark, lenient) is None
    assert one(spark, columns.arrival_date(F.lit(2016), F.lit("July"), F.lit(4))) == date(2016, 7, 4)
    for month, day in (("Januar", 1), ("February", 30)):
        with pytest.raises(Exception):
            one(spark, columns.arrival_date(F.lit(2016), F.lit(month), F.lit(day)))


@pytest.mark.parametrize(
    "day,months,expected",
    [
        (date(2017, 5, 31), -3, date(2017, 2, 28)),
        (date(2016, 5, 31), -3, date(2016, 2, 29)),
        (date(2020, 12, 15), 1, date(2021, 1, 15)),
        (date(2020, 1, 31), -2, date(2019, 11, 30)),
        (date(2020, 6, 1), 12, date(2021, 6, 1)),
    ],
)
def test_add_months(day, months, expected):
    assert add_months(day, months) == expected


def test_codes_weeks_and_stays(spark):
    rows = spark.createDataFrame([(9, None, 2, 3), (None, 5, 0, 0), (1, 1, None, 4)], "a int, c int, e int, w int")
    assert [r.v for r in rows.select(columns.code_or_unknown("a").alias("v")).collect()] == ["9", "Unknown", "1"]
    assert [r.v for r in rows.select(columns.length_of_stay("e", "w").alias("v")).collect()] == [5, 1, 4]
    assert one(spark, columns.length_of_stay(None, None)) == 1
    assert one(spark, columns.week_of_path(F.lit("/x/week_07.csv"))) == 7
    assert one(spark, columns.week_of_path(F.lit("/x/test.csv"))) == 0
