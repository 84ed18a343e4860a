import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import booking, three_bookings
from roomtide import schema
from roomtide.operators import cleaning, features, forests, levels, models
from roomtide.streaming import streams


@pytest.fixture(scope="module")
def cleaned(make_raw):
    rows = [
        booking(lead_time=i % 200, adr=50.0 + i % 90, is_canceled=int((i * 7919) % 100 < 20 + (i % 200) // 4), agent=i % 3,
                country="PRT" if i % 5 else None, children=None if i % 50 == 0 else i % 3, arrival_date_day_of_month=1 + i % 28)
        for i in range(900)
    ]
    return cleaning.clean(make_raw(rows), "seq").cache()


def test_features(make_raw):
    rows = cleaning.clean(make_raw([booking(), booking(country=None, agent=None, children=None, lead_time=3)]), "seq", max_percent=100)
    built = features.build_features(rows, keep=["row_id"]).orderBy("row_id").collect()
    assert not set(schema.LEAKAGE_COLUMNS + ["is_canceled", "arrival_date_year", "arrival_date"]) & set(built[0].asDict())
    first, second = built
    assert (first.agent, first.company, first.company_missing, first.country_missing) == ("9", "Unknown", 1, 0)
    assert (second.country, second.agent, second.children, second.children_missing) == ("Unknown", "Unknown", 0, 1)
    slim = features.build_features(rows, include_team_decision=False)
    assert "adr" not in slim.columns and features.feature_lists(slim.columns)[0].count("adr") == 0
    with pytest.raises(ValueError, match="not found"):
        features.build_features(rows.drop("row_id"))
    with pytest.raises(features.LeakageError):
        features.check_no_leakage(rows)


def test_duplicates_leave_train_completely(make_raw):
    rows = cleaning.clean(make_raw([*three_bookings(), three_bookings()[0]]), "seq")
    assert features.drop_duplicates_from_train(rows).count() == 2


def test_align(make_raw):
    raw = make_raw(three_bookings()).drop("meal").withColumn("more", F.lit(1))
    found = features.align(raw, schema.RAW_SCHEMA, {"meal": "BB"})
    assert found.columns == schema.RAW_COLUMNS and {r.meal for r in found.collect()} == {"BB"}
    assert features.align(raw, schema.RAW_SCHEMA).first().meal is None


def test_baseline_falls_back_to_overall(spark):
    train = spark.createDataFrame([("A", "July", 1), ("A", "July", 0), ("B", "May", 0)], "hotel string, arrival_date_month string, is_canceled int")
    rows = spark.createDataFrame([("A", "July"), ("A", "May")], "hotel string, arrival_date_month string")
    found = {r.arrival_date_month: r.p_cancel for r in features.baseline_predict(train, rows).collect()}
    assert found == {"July": 0.5, "May": pytest.approx(1 / 3)}


def test_preprocessing(spark):
    values = [(1.0, "a"), (2.0, "a"), (3.0, "b"), (10.0, "c"), (None, None)]
    train = spark.createDataFrame(values, "x double, g string")
    assert models.exact_medians(train, ["x"]) == {"x": 2.5}
    stages = models.preprocessing_stages(train, ["x"], ["g"], min_frequency=2)
    from pyspark.ml import Pipeline

    model = Pipeline(stages=stages).fit(train)
    new = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "never")], "x double, g string")
    out = [r.v for r in model.transform(new).select(vector_to_array("features").alias("v")).collect()]
    x = np.array([1, 2, 3, 10, 2.5])
    scaled = (np.array([1, 2.5, 3]) - x.mean()) / x.std()
    assert np.allclose([v[0] for v in out], scaled)
    # one column for the frequent level, one for all rare levels, none for an unseen one
    assert [v[1:] for v in out] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_calibrated_model(spark, cleaned, tmp_path):
    rows = cleaned.withColumn("split", F.element_at(F.array(*map(F.lit, schema.SPLITS[:3])), (F.col("row_id") % 3 + 1).cast("int")))
    model, effect = models.train_calibrated(rows, models.random_forest(10, 5, 10))
    stages = {r.stage: r for r in effect.collect()}
    assert stages["after"].n_rows == stages["before"].n_rows == 300
    assert 0.4 < stages["before"].roc_auc <= 1 and stages["after"].brier < 0.3
    test = features.build_features(cleaned, keep=["row_id"])
    scored = model.score(test, keep_raw=True).orderBy("p_raw").toPandas()
    assert (np.diff(scored["p_cancel"]) >= -1e-12).all() and scored["p_cancel"].between(0, 1).all()
    model.save(str(tmp_path / "m"))
    again = models.CalibratedModel.load(str(tmp_path / "m")).score(test).orderBy("row_id").toPandas()
    assert np.allclose(again["p_cancel"], model.score(test).orderBy("row_id").toPandas()["p_cancel"])
    assert models.CalibratedModel.load(str(tmp_path / "none")) is None
    stored = str(tmp_path / "features")
    test.write.parquet(stored)
    stream = streams.score_stream(model, streams.read_table_stream(spark, stored, test.schema))
    streamed = streams.run_available(stream, "scores").orderBy("row_id").toPandas()
    assert np.allclose(streamed["p_cancel"], again["p_cancel"]) and (streamed["row_id"] == again["row_id"]).all()
    batch = models.score_bookings(model, cleaned, lambda d: features.build_features(d, keep=["row_id"])).toPandas()
    assert (batch["will_cancel"] == (again.set_index("row_id").loc[batch["row_id"], "p_cancel"].to_numpy() >= 0.5)).all()


def test_experiments(cleaned):
    parts = [features.build_features(cleaned.filter(F.col("row_id") % 2 == i), keep=["is_canceled"]) for i in (0, 1)]
    chosen = {"logistic_regression": models.logistic_regression(450, max_iter=20), "boosted_trees": models.boosted_trees(2, depth=3)}
    table, fitted = models.run_experiments(*parts, chosen)
    rows = {r.run: r for r in table.collect()}
    assert set(rows) == set(fitted) == set(chosen)
    assert "stepSize" in rows["boosted_trees"].params and rows["boosted_trees"].train_fingerprint.startswith("450:")


def test_level_table(spark):
    rows = [("b", 1), ("b", 2), ("a", 1), ("a", 1), ("c", None), (None, 3), (None, 3), ("B", 3)]
    train = spark.createDataFrame(rows, "g string, `h.x` int")
    table = levels.level_table(train, ["g", "h.x"], 2, rows_per_range=1)
    found = {(r.feature, r.level): (r.n, r["index"]) for r in table.collect()}
    assert found == {
        ("g", "a"): (2, 0), ("g", "b"): (2, 1), ("g", "missing"): (2, 2), ("g", "B"): (1, 3), ("g", "c"): (1, 3),
        ("h.x", "1"): (3, 0), ("h.x", "3"): (3, 1), ("h.x", "2"): (1, 2), ("h.x", "missing"): (1, 2),
    }
    assert levels.level_widths(table, ["g", "h.x", "none"]) == {"g": 4, "h.x": 3, "none": 0}
    new = spark.createDataFrame([(1, "a", "x"), (2, "z", "y"), (3, None, "y"), (3, None, "y")], "id int, g string, _level string")
    got = sorted((r.id, r.g_at) for r in levels.join_levels(new, table, {"g": "g"}, {"g": "g_at"}).collect() if r.g_at is not None)
    assert got == [(1, 0), (3, 2), (3, 2)]
    empty = levels.level_table(train.limit(0), ["g"], 2)
    assert empty.count() == 0 and levels.join_levels(new, empty, {"g": "g"}, {"g": "g_at"}).where("g_at is null").count() == 4


def test_all_levels_rare_or_frequent(spark):
    train = spark.createDataFrame([(i, f"u{i}", "same", float(i % 2)) for i in range(50)], "x int, g string, h string, is_canceled double")
    stages = models.preprocessing_stages(train, ["x"], ["g", "h"], min_frequency=2)
    from pyspark.ml import Pipeline

    out = Pipeline(stages=stages).fit(train).transform(train).select("features").collect()
    assert {tuple(r.features.toArray()[1:]) for r in out} == {(1.0, 1.0)}


def test_a_model_of_very_many_levels(spark, tmp_path):
    """More levels than a driver list should hold; the label follows the level, so the weights must be those of the right columns."""
    n = 250_000
    train = spark.range(2 * n).select(
        F.concat(F.lit("g"), F.col("id") % n).alias("g"), F.lit(1.0).alias("x"), (F.col("id") % n % 2).cast("double").alias("is_canceled")
    )
    model = models.fit_classifier(train, models.logistic_regression(2 * n, c=1000.0, max_iter=5), ["x"], ["g"], min_frequency=2)
    assert model.stages[-1].numFeatures == n + 1
    model.write().save(str(tmp_path / "wide"))
    again = type(model).load(str(tmp_path / "wide"))
    scored = models.add_probability(again, train.limit(1000))
    assert scored.where((F.col("p_raw") > 0.5) != (F.col("is_canceled") == 1)).count() == 0


@pytest.mark.parametrize("boosted", [False, True])
def test_a_walk_over_the_node_table_scores_like_the_model(spark, boosted, monkeypatch):
    rows = spark.range(600).select(
        F.col("id").alias("row_id"), (F.col("id") * 37 % 101).cast("double").alias("a"), F.concat(F.lit("g"), F.col("id") % 7).alias("g"),
        ((F.col("id") * 37 % 101 + F.col("id") % 7 * 9) > 75).cast("double").alias("is_canceled"),
    )
    classifier = models.boosted_trees(6, depth=4) if boosted else models.random_forest(8, 5, 3)
    model = models.fit_classifier(rows, classifier, ["a"], ["g"])
    nodes = forests.node_table(model.stages[-1]).cache()
    assert nodes.select("tree").distinct().count() == (6 if boosted else 8) and nodes.where("categories is not null").count() > 0
    given = model.transform(rows).select("row_id", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("want"))
    for sent in (forests.SENT_BYTES, 0):  # with the nodes at all tasks, and joined
        monkeypatch.setattr(forests, "SENT_BYTES", sent)
        got = forests.forest_scores(given, nodes, 5, boosted).join(given, "row_id").select("p", "want").toPandas()
        assert len(got) == 600 and np.allclose(got["p"], got["want"], atol=1e-12)
    assert forests.split_counts(nodes).agg(F.sum("n_splits")).first()[0] == nodes.where("lft >= 0").count()
    assert forests.forest_scores(given.limit(0), nodes, 5, boosted).count() == 0


def test_gradient_vanishes_at_the_fitted_weights(spark):
    rows = spark.range(2000).select(
        (F.col("id") * 37 % 101 / 10).alias("a"), (F.col("id") % 3).cast("string").alias("g"),
        ((F.col("id") * 7919 % 997) < 200 + F.col("id") * 37 % 101 * 5).cast("double").alias("is_canceled"),
    )
    best = models.fit_classifier(rows, models.logistic_regression(2000).setTol(1e-12), ["a"], ["g"])
    assert np.linalg.norm(models.fitted_gradient(best, rows)) < 1e-4
    early = models.fit_classifier(rows, models.logistic_regression(2000, max_iter=1), ["a"], ["g"])
    found = models.fitted_gradient(early, rows)
    assert np.linalg.norm(found) > 1e-3
    # the same from columns
    flat = early.transform(rows).select("is_canceled", *[vector_to_array("features")[i].alias(f"x{i}") for i in range(len(found) - 1)])
    fitted = early.stages[-1]
    weights = {f"x{i}": w for i, w in enumerate(fitted.coefficients.toArray())}
    table = {r.feature: r.gradient for r in models.logistic_gradient(flat, weights, fitted.intercept, penalty=fitted.getRegParam()).collect()}
    assert np.allclose([table[f] for f in [*weights, "(intercept)"]], found, atol=1e-9)


def test_rows_to_fit_are_dealt_to_all_cores(spark):
    rows = spark.range(400).coalesce(1).selectExpr("id % 3 as a", "cast(id % 2 as int) as is_canceled")
    cores = spark.sparkContext.defaultParallelism
    assert models.spread(rows).rdd.getNumPartitions() == cores and models.spread(rows, 20).rdd.getNumPartitions() >= 20
    sizes = models.spread(rows).rdd.glom().map(len).collect()
    assert sum(sizes) == 400 and max(sizes) <= 2 * 400 // cores
