"""Preprocessing, classifiers, calibration and batch scoring on Spark ML."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide import schema
from roomtide.operators.boosting import BoostedTrees
from roomtide.operators.features import build_features, check_no_leakage, feature_lists
from roomtide.operators.levels import LevelEncoder, long_levels
from roomtide.operators.metrics import compute_metrics, metrics_by_column, score_table, with_label
from roomtide.operators.quantiles import exact_quantiles
from roomtide.session import cut_lineage
from roomtide.sources.hashes import fingerprint

SEED = 42
MIN_FREQUENCY = 20
ROWS_PER_TASK = 250_000  # rows of a table to fit or score, at most, in one task
NODE_IDS_BYTES = 2 << 30  # a forest's fit keeps up to so much beside the rows: the node of each row in each tree


# --- Preprocessing ----------------------------------------------------------


def exact_medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median of every feature, all in one distributed job."""
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    long = df.select(F.inline(F.array(*pairs)))
    return {r.feature: r.median for r in exact_quantiles(long, "value", {"median": 0.5}, ["feature"]).collect()}


def numeric_statistics(train: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """feature, median, and the mean and population deviation once missing values have the median. One row per feature."""
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in numeric]
    long = train.select(F.inline(F.array(*pairs)))
    medians = exact_quantiles(long, "value", {"median": 0.5}, ["feature"])
    present, rows = F.count("value"), F.count("*")
    sums = long.groupBy("feature").agg(
        (rows - present).alias("_missing"), rows.alias("_n"), present.alias("_present"), F.avg("value").alias("_mean"), F.var_pop("value").alias("_var")
    )
    # the missing rows enter as so many copies of the median
    known = sums.join(medians, "feature")
    share = F.col("_present") / F.col("_n")
    mean = share * F.col("_mean") + (1 - share) * F.col("median")
    spread = share * (F.col("_var") + F.pow(F.col("_mean") - mean, 2)) + (1 - share) * F.pow(F.col("median") - mean, 2)
    return known.select("feature", "median", mean.alias("mean"), F.sqrt(spread).alias("deviation"))


def level_states(
    train: DataFrame, rows: DataFrame, features: Sequence[str], min_frequency: int = MIN_FREQUENCY
) -> DataFrame:
    """feature, level, rows, and what training makes of the level: frequent, rare (shares a column) or unseen (no column)."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return long_levels(df, features).groupBy("feature", "level").agg(F.count("*").alias(name))

    joined = counted(rows, "n_rows").join(counted(train, "n_train"), ["feature", "level"], "left")
    state = F.when(F.col("n_train") >= min_frequency, "frequent").when(F.col("n_train") > 0, "rare").otherwise("unseen")
    return joined.select("feature", "level", "n_rows", state.alias("state"))


def preprocessing_stages(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], min_frequency: int = MIN_FREQUENCY
) -> list:
    """Stages fitted on ``train``: median fill and standardization, constant fill and one-hot levels.

    Levels seen fewer than ``min_frequency`` times share one column; a level not seen at
    all gets no column. Deviations are of the population.
    """
    known = {r.feature: r for r in numeric_statistics(train, numeric).collect()}  # a row per feature
    scaled = []
    for c in numeric:
        median, mean, deviation = (known[c].median, known[c].mean, known[c].deviation or 1.0) if c in known else (0.0, 0.0, 1.0)
        value = f"coalesce(double(`{c}`), double({median!r}))"
        scaled.append(f"({value} - double({mean!r})) / double({deviation!r}) AS `{c}_num`")
    stages = [SQLTransformer(statement=f"SELECT {', '.join(['*', *scaled])} FROM __THIS__")]
    stages.append(LevelEncoder.fitted(train, categorical, min_frequency))
    stages.append(
        OneHotEncoder(
            inputCols=[f"{c}_level" for c in categorical],
            outputCols=[f"{c}_hot" for c in categorical],
            handleInvalid="keep",
            dropLast=True,
        )
    )
    inputs = [f"{c}_num" for c in numeric] + [f"{c}_hot" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages


# --- Classifiers ------------------------------------------------------------


def spread(rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` dealt evenly to all cores, in as many parts a core as ``rows_per_task`` asks for.

    A table that is small on disk is read by one task or a few, however long each row takes to fit or score.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores * max(1, -(-rows.count() // (cores * rows_per_task))))



def logistic_regression(n_rows: int, label: str = schema.TARGET, c: float = 1.0, max_iter: int = 1000) -> Estimator:
    return LogisticRegression(
        labelCol=label, maxIter=max_iter, regParam=1.0 / (c * max(1, n_rows)), elasticNetParam=0.0, standardization=False
    )


def random_forest(
    trees: int = 300, depth: int = 12, leaf: int = 20, label: str = schema.TARGET, seed: int = SEED
) -> Estimator:
    return RandomForestClassifier(
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf,
        featureSubsetStrategy="sqrt",
        seed=seed,
        maxMemoryInMB=1024,
    )


def boosted_trees(rounds: int = 500, step: float = 0.05, depth: int = 6, label: str = schema.TARGET, seed: int = SEED) -> Estimator:
    return BoostedTrees(
        labelCol=label, maxIter=rounds, stepSize=step, maxDepth=depth, seed=seed, checkpointInterval=10, maxMemoryInMB=1024
    )


def standard_experiments(n_rows: int, trees: int = 300, rounds: int = 500) -> dict[str, Estimator]:
    """The classifiers compared by default; the tuned forest is the one that goes on to calibration."""
    return {
        "logistic_regression": logistic_regression(n_rows),
        "random_forest": random_forest(trees, 12, 20),
        "random_forest_tuned": random_forest(trees, 8, 50),
        "boosted_trees": boosted_trees(rounds),
    }


def fitting_rows(prepared: PipelineModel, train: DataFrame, *classifiers: Estimator) -> DataFrame:
    """What classifiers read of ``train``, prepared once, written, and dealt to all cores."""
    columns = {"features"}
    for c in classifiers:
        columns |= {c.getOrDefault(p) for p in ("labelCol", "weightCol", "featuresCol") if c.hasParam(p) and c.isDefined(p) and c.getOrDefault(p)}
    return spread(cut_lineage(prepared.transform(train).select(*sorted(columns)), "fitting"))


def fit_prepared(classifier: Estimator, rows: DataFrame, n_rows: int) -> Model:
    """The classifier fitted on ``rows``; a forest keeps the node of each row, rather than walk from the root at every level.

    The trees are the same, and the model carries the settings of ``classifier``.
    """
    if not isinstance(classifier, RandomForestClassifier) or n_rows * classifier.getNumTrees() * 4 > NODE_IDS_BYTES:
        return classifier.fit(rows)
    fitted = classifier.copy({classifier.cacheNodeIds: True}).fit(rows)
    return fitted._set(cacheNodeIds=classifier.getCacheNodeIds())


def fit_classifier(
    train: DataFrame,
    classifier: Estimator,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    prepared: PipelineModel | None = None,
    min_frequency: int = MIN_FREQUENCY,
) -> PipelineModel:
    """Preprocessing and classifier as one model that can be saved and loaded.

    ``prepared`` is preprocessing already fitted on ``train``, for several classifiers of one table.
    """
    if prepared is not None:
        fitted = classifier.fit(fitting_rows(prepared, train, classifier))
        return PipelineModel(stages=[*prepared.stages, fitted])
    if numeric is None or categorical is None:
        numeric, categorical = feature_lists(train.columns)
    check_no_leakage(train.select(*numeric, *categorical))
    stages = preprocessing_stages(train, numeric, categorical, min_frequency)
    return fit_classifier(train, classifier, prepared=Pipeline(stages=stages).fit(train))


def add_probability(model: PipelineModel, rows: DataFrame, out: str = "p_raw") -> DataFrame:
    """Rows with the probability of the positive class; helper columns of the model are dropped."""
    scored = model.transform(rows)
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias(out))


# --- Optimality of a linear model -------------------------------------------


def logistic_gradient(
    rows: DataFrame, weights: Mapping[str, float], intercept: float = 0.0, label: str = schema.TARGET, penalty: float = 0.0
) -> DataFrame:
    """feature and gradient of the penalised mean log loss at given weights, in one aggregate; ``(intercept)`` has no penalty.

    Rows with a null in the label or a feature are left out. At the best weights every value is zero.
    """
    known = rows.dropna(subset=[*weights, label])
    x = {f: F.col(f"`{f}`").cast("double") for f in weights}
    margin = sum((F.lit(float(w)) * x[f] for f, w in weights.items()), F.lit(float(intercept)))
    error = 1 / (1 + F.exp(-margin)) - F.col(f"`{label}`")
    names = [*weights, "(intercept)"]
    sums = known.agg(*[F.avg(error * x.get(f, F.lit(1.0))).alias(f"_{i}") for i, f in enumerate(names)])
    parts = [
        F.struct(F.lit(f).alias("feature"), (F.col(f"_{i}") + penalty * float(weights.get(f, 0.0))).alias("gradient")) for i, f in enumerate(names)
    ]
    return sums.select(F.inline(F.array(*parts)))


def fitted_gradient(model: PipelineModel, train: DataFrame, label: str = schema.TARGET) -> np.ndarray:
    """Gradient of a fitted logistic model's own loss over ``train``: one value per weight, the intercept last.

    Spark sums the feature vectors of each label, weighted by the error of the row; two vectors as wide as
    the model come back. A norm near zero certifies that the fit ended at the optimum.
    """
    fitted = model.stages[-1]
    p = vector_to_array("probability")[1]
    positive = F.col(label) == 1
    scored = model.transform(train).where(F.col(label).isNotNull())
    scored = scored.select("features", positive.alias("_y"), F.when(positive, 1 - p).otherwise(p).alias("_w"))
    sums = scored.groupBy("_y").agg(Summarizer.sum(F.col("features"), F.col("_w")).alias("s"), F.sum("_w").alias("w"), F.count("*").alias("n")).collect()
    total, n = np.zeros(fitted.numFeatures + 1), 0
    for row in sums:  # one row per label
        total += (-1 if row._y else 1) * np.append(row.s.toArray(), row.w)
        n += row.n
    return total / max(1, n) + fitted.getRegParam() * np.append(fitted.coefficients.toArray(), 0.0)


# --- Calibration ------------------------------------------------------------


@dataclass
class CalibratedModel:
    """A frozen classifier and the monotone map from its scores to calibrated probabilities."""

    classifier: PipelineModel
    calibrator: IsotonicRegressionModel

    def score(self, rows: DataFrame, out: str = "p_cancel", keep_raw: bool = False) -> DataFrame:
        raw = add_probability(self.classifier, rows, "p_raw")
        mapped = self.calibrator.transform(raw).withColumnRenamed("prediction", out)
        return mapped if keep_raw else mapped.drop("p_raw")

    def save(self, path: str) -> None:
        self.classifier.write().overwrite().save(f"{path}/classifier")
        self.calibrator.write().overwrite().save(f"{path}/calibrator")

    @staticmethod
    def load(path: str) -> CalibratedModel | None:
        """The saved model, or None when there is none at ``path``."""
        try:
            return CalibratedModel(
                PipelineModel.load(f"{path}/classifier"), IsotonicRegressionModel.load(f"{path}/calibrator")
            )
        except Exception as error:
            if "Path does not exist" in str(error) or "does not exist" in str(error):
                return None
            raise


def monotone_map(scored: DataFrame, label: str = schema.TARGET, score: str = "p_raw") -> IsotonicRegressionModel:
    """The increasing map from scores to label rates with the least squared error. Equal scores are pooled first."""
    pooled = score_table(scored, label, score)
    weighted = pooled.select(
        F.col("p").alias("p_raw"), (F.col("pos") / F.col("n")).alias("_rate"), F.col("n").cast("double").alias("_n")
    )
    return IsotonicRegression(featuresCol="p_raw", labelCol="_rate", weightCol="_n", isotonic=True).fit(weighted)


def calibrate(classifier: PipelineModel, validation: DataFrame, label: str = schema.TARGET) -> CalibratedModel:
    """Fit the monotone map on validation rows only."""
    scored = cut_lineage(add_probability(classifier, spread(validation), "p_raw").select("p_raw", label), "calibration")
    return CalibratedModel(classifier, monotone_map(scored, label))


def calibration_effect(model: CalibratedModel, test: DataFrame, label: str = schema.TARGET) -> DataFrame:
    """Metrics of the same untouched rows before and after calibration."""
    scored = model.score(spread(test), "p_cancel", keep_raw=True).select("p_raw", "p_cancel", label)
    scored = cut_lineage(scored, "tested")
    return metrics_by_column(scored, {"before": "p_raw", "after": "p_cancel"}, label)


# --- Experiments and scoring ------------------------------------------------


def run_experiments(
    train: DataFrame, validation: DataFrame, classifiers: Mapping[str, Estimator], label: str = schema.TARGET
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Validation metrics of every classifier with its settings and the training data's fingerprint."""
    mark = fingerprint(train).first()
    train_mark = f"{mark.n_rows}:{mark.hash_sum}:{mark.hash_xor}"
    models, tables = {}, []
    numeric, categorical = feature_lists(train.columns)
    check_no_leakage(train.select(*numeric, *categorical))
    prepared = Pipeline(stages=preprocessing_stages(train, numeric, categorical)).fit(train)
    ready = fitting_rows(prepared, train, *classifiers.values())
    # a fit that takes one task goes beside the others, which have the other cores meanwhile
    with ThreadPoolExecutor(1) as beside:
        begun = {n: beside.submit(c.fit, ready) for n, c in classifiers.items() if isinstance(c, BoostedTrees) and c.in_one_task(ready)}
        for name, classifier in classifiers.items():
            fitted = begun[name].result() if name in begun else fit_prepared(classifier, ready, mark.n_rows)
            models[name] = PipelineModel(stages=[*prepared.stages, fitted])
            settings = {p.name: v for p, v in classifier.extractParamMap().items()}
            scored = add_probability(models[name], spread(validation), "p").select(F.col(label).alias("y"), "p")
            scored = cut_lineage(scored, "validated")  # the metrics read the scores in several jobs
            tables.append(
                compute_metrics(scored).select(
                    F.lit(name).alias("run"),
                    "*",
                    F.lit(json.dumps(settings, default=str, sort_keys=True)).alias("params"),
                    F.lit(train_mark).alias("train_fingerprint"),
                )
            )
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result, models


def train_calibrated(
    splits: DataFrame, classifier: Estimator | None = None, label: str = schema.TARGET
) -> tuple[CalibratedModel, DataFrame]:
    """Fit on train, calibrate on validation, report on test. ``splits`` has cleaned rows and ``split``."""
    parts = {name: build_features(splits.filter(F.col("split") == name).drop("split"), keep=[label]) for name in schema.SPLITS[:3]}
    fitted = fit_classifier(parts["train"], classifier or random_forest(300, 8, 50, label))
    model = calibrate(fitted, parts["validation"], label)
    return model, calibration_effect(model, parts["test"], label)


def score_bookings(
    model: CalibratedModel, rows: DataFrame, features: Callable[[DataFrame], DataFrame] | None = None, threshold: float = 0.5
) -> DataFrame:
    """Batch scoring: probability and label. ``features`` turns raw rows into features and must keep ``row_id``."""
    prepared = features(rows) if features else rows
    scored = with_label(model.score(prepared), "p_cancel", threshold)
    return scored.withColumn("p_cancel", F.round("p_cancel", 4))
