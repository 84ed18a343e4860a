import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.operators import quantiles, ranking


@pytest.mark.parametrize("share", [0.0, 0.4, 1.0])
def test_row_numbers_with_a_dominant_value(spark, share):
    values = [(i, 500 if i < 20_000 * share else (i * 7919) % 1000) for i in range(20_000)]
    rows = spark.createDataFrame(values, "id long, v long")
    found = ranking.row_numbers(rows, "v", "id", out="n", rows_per_range=500).toPandas().sort_values(["v", "id"])
    assert found["n"].tolist() == list(range(20_000))


def test_ranges_stay_small_for_a_dominant_value(spark):
    rows = spark.createDataFrame([(float(i), 1.0 if i % 3 else float(i)) for i in range(30_000)], "t double, k double")
    limits, frequent = ranking.value_ranges(rows, "k", 30)
    assert list(frequent) == [1.0]
    sizes = ranking.with_range(rows, "k", limits, "r").filter("k <> 1.0").groupBy("r").count().agg(F.max("count")).first()[0]
    assert sizes <= 3 * 30_000 / 30


def test_top_rows_is_the_same_for_any_cut(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 5).alias("g"), ((F.col("id") * 37) % 101).alias("v"))
    order = [F.col("v").desc(), F.col("id").asc()]
    found = [
        sorted(map(tuple, ranking.top_rows(rows, ["g"], order, 20, "id", salts=salts).collect())) for salts in (1, 7, None)
    ]
    assert found[0] == found[1] == found[2]
    assert [r[-1] for r in sorted(map(tuple, ranking.top_rows(rows, ["g"], order, 2000, "id").filter("g = 0").collect()), key=lambda r: r[-1])] == list(range(1, 2001))


@pytest.mark.parametrize("per_range", [100, 1_000_000])
def test_exact_quantiles(spark, per_range):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=2000).round(3), np.full(1500, 0.25), [1e9, -1e9]])
    groups = np.where(np.arange(len(values)) % 3 == 0, "a", "b")
    rows = spark.createDataFrame([(str(g), float(v)) for g, v in zip(groups, values)], "g string, v double").repartition(5)
    levels = {"lo": 0.0, "q": 0.37, "med": 0.5, "hi": 1.0}
    for row in quantiles.exact_quantiles(rows, "v", levels, ["g"], per_range).collect():
        expected = np.quantile(values[groups == row.g], list(levels.values()))
        assert np.allclose([row[n] for n in levels], expected, rtol=0, atol=1e-9)



def test_two_levels_of_ranges_equal_a_plain_window(spark):
    rows = spark.range(1_000_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(300_000))).cast("double").alias("v"))
    placed = ranking.with_value_ranges(rows, "v", ranking.ranges_for(1_000_000, 10), "r")
    found = placed.groupBy("r").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"), F.countDistinct("v").alias("values"))
    # ranges follow the order of the values, and only the value that a third of the rows have fills a large one
    table = found.orderBy("r").toPandas()
    assert (table["low"].iloc[1:].to_numpy() > table["high"].iloc[:-1].to_numpy()).all() and table["n"].sum() == 1_000_000
    assert len(table) > 30_000 and table[(table["low"] > 7) | (table["high"] < 7)]["n"].max() <= 200


def test_exact_quantiles_over_two_levels(spark, monkeypatch):
    monkeypatch.setattr(ranking, "LIMITS", 8)
    monkeypatch.setattr(ranking.with_value_ranges, "__defaults__", (8,))
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(5_000)).cast("double").alias("v"))
    values = np.array([r.v for r in rows.collect()])
    found = quantiles.exact_quantiles(rows, "v", {"q": 0.37, "m": 0.5}, rows_per_range=100).first()
    assert np.allclose([found.q, found.m], np.quantile(values, [0.37, 0.5]))


def test_row_numbers_over_many_ranges_equal_a_window(spark):
    rows = spark.range(100_000).select(F.col("id").alias("range"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("k1"), F.lit("x").alias("row"))
    found = ranking.row_numbers(rows, "k1", "range", out="n", rows_per_range=1_000)
    assert found.columns == ["range", "k1", "row", "n"]
    table = found.toPandas().sort_values(["k1", "range"])
    assert table["n"].tolist() == list(range(100_000)) and set(table["row"]) == {"x"}


def test_helpers_leave_columns_of_the_caller_alone(spark):
    rows = spark.createDataFrame([(i, f"t{i}", i % 7) for i in range(3_000)], "id long, _k1 string, _local int")
    rows = rows.withColumns({"_salt": F.col("id"), "_piece": F.col("id"), "_coarse": F.col("id"), "_cuts": F.col("id"), "_key": F.col("id")})
    numbered = ranking.row_numbers(rows, "id", rows_per_range=500)
    assert all(r._k1 == f"t{r.id}" and r._local == r.id % 7 and r.row_id == r.id for r in numbered.collect())
    top = ranking.top_rows(rows, ["_local"], [F.col("id")], 3, "id", salts=4)
    assert all(r._salt == r._piece == r.id for r in top.collect()) and top.count() == 21
    ranged = ranking.with_value_ranges(rows, "id", 100, "r", limits_per_level=10)
    assert ranged.columns == [*rows.columns, "r"] and all(r._coarse == r._cuts == r._key == r.id for r in ranged.collect())
