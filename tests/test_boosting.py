import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from roomtide.operators import boosting, models

SETTINGS = {"labelCol": "is_canceled", "stepSize": 0.05, "seed": 42}


def rows_of(spark, n):
    """Hashes of the number: ``u`` has far more values than there are split candidates, ``c`` four."""
    draw = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1_000_003)) / 1_000_003
    rows = spark.range(n).select("id", (draw(1) * draw(2)).alias("u"), F.floor(draw(3) * 4).alias("c"), F.concat(F.lit("g"), F.floor(draw(4) * 6)).alias("g"), draw(5).alias("v"))
    return rows.select("id", "u", "c", "g", (F.col("v") < 0.2 + F.col("u") / 2 + (F.col("g") == "g3").cast("int") * 0.3).cast("int").alias("is_canceled"))


def prepared(spark, n):
    rows = rows_of(spark, n)
    stages = models.preprocessing_stages(rows, ["u", "c"], ["g"])
    return models.fitting_rows(Pipeline(stages=stages).fit(rows), rows, models.boosted_trees(1)).cache()


def scores(model, rows):
    found = model.transform(rows).select(vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p"))
    return found.orderBy("x").toPandas()["p"].to_numpy()


@pytest.mark.parametrize("n,more", [(700, {"minInstancesPerNode": 5}), (20_000, {}), (700, {"minInfoGain": 0.002, "maxBins": 7})])
def test_the_trees_are_those_of_spark(spark, n, more):
    rows = prepared(spark, n)
    own = boosting.BoostedTrees(maxIter=6, maxDepth=4, **SETTINGS, **more)
    assert own.in_one_task(rows)
    found, want = own.fit(rows), GBTClassifier(maxIter=6, maxDepth=4, **SETTINGS, **more).fit(rows)
    assert isinstance(found, GBTClassificationModel) and found.getNumTrees == want.getNumTrees == 6
    assert found.treeWeights == want.treeWeights and found.numFeatures == want.numFeatures and found.getMaxIter() == 6
    assert np.allclose(scores(found, rows), scores(want, rows), atol=1e-9)
    assert np.allclose(found.featureImportances.toArray().sum(), 1)


def test_rounds_do_not_run_jobs(spark):
    rows = prepared(spark, 500)
    spark.sparkContext.setJobGroup("boosted", "a fit")
    try:
        models.boosted_trees(25, depth=4).fit(rows)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("boosted")) < 25


def test_a_saved_model_scores_the_same(spark, tmp_path):
    rows = prepared(spark, 500)
    model = models.boosted_trees(3, depth=3).fit(rows)
    model.write().save(str(tmp_path / "m"))
    assert np.array_equal(scores(GBTClassificationModel.load(str(tmp_path / "m")), rows), scores(model, rows))


def test_what_spark_has_to_fit(spark, monkeypatch):
    rows = prepared(spark, 300)
    assert not models.boosted_trees(2).setSubsamplingRate(0.5).in_one_task(rows)
    monkeypatch.setattr(boosting, "ONE_TASK_BYTES", 100)
    assert not models.boosted_trees(2).in_one_task(rows)
    assert models.boosted_trees(2, depth=2).fit(rows).getNumTrees == 2


def test_one_label_and_columns_of_one_value(spark):
    rows = spark.range(40).selectExpr("1.0 as a", "id % 3 as b", "1 as is_canceled")
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    found, want = models.boosted_trees(3, depth=2).fit(ready), GBTClassifier(maxIter=3, maxDepth=2, **SETTINGS).fit(ready)
    assert np.allclose(scores(found, ready), scores(want, ready))


@pytest.mark.parametrize("label", ["null", "2"])
def test_other_labels_still_raise(spark, label):
    rows = spark.range(40).selectExpr("id % 3 as b", f"if(id = 7, {label}, id % 2) as is_canceled")
    with pytest.raises(Exception):
        models.boosted_trees(2, depth=2).fit(VectorAssembler(inputCols=["b"], outputCol="features").transform(rows))


def test_a_forest_that_keeps_nodes_is_the_same(spark):
    rows = prepared(spark, 900)
    classifier = models.random_forest(12, 6, 5)
    found, want = models.fit_prepared(classifier, rows, 900), classifier.fit(rows)
    assert found.toDebugString.split("\n")[1:] == want.toDebugString.split("\n")[1:]
    assert found.getCacheNodeIds() is want.getCacheNodeIds() is False and "cacheNodeIds" in classifier.explainParams()
