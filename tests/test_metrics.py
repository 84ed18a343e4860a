import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.operators import metrics, ranking


def scored(spark, p, y, **more):
    return spark.createDataFrame([(int(b), float(a)) for a, b in zip(p, y)], "y int, p double")


def brute(p, y):
    p, y = np.asarray(p, float), np.asarray(y)
    order = np.unique(p)[::-1]
    ap = last = 0.0
    for t in order:
        chosen = p >= t
        recall = y[chosen].sum() / y.sum()
        ap += (recall - last) * y[chosen].mean()
        last = recall
    pos, neg = p[y == 1], p[y == 0]
    pairs = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    eps = np.finfo(float).eps
    q = np.clip(p, eps, 1 - eps)
    loss = -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()
    ids = np.digitize(p, np.linspace(0, 1, 11)[1:-1])
    ece = sum((ids == b).mean() * abs(y[ids == b].mean() - p[ids == b].mean()) for b in set(ids))
    return {"pr_auc": ap, "roc_auc": pairs, "log_loss": loss, "brier": ((p - y) ** 2).mean(), "ece": ece}


def test_known_average_precision(spark):
    found = metrics.compute_metrics(scored(spark, [0.9, 0.8, 0.7, 0.6, 0.2, 0.1], [1, 0, 1, 0, 0, 1])).first()
    assert found.pr_auc == pytest.approx(0.7222222, abs=1e-6)


@pytest.mark.parametrize("kind", ["spread", "ties", "edges", "tiny"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    p = rng.random(600)
    if kind == "ties":
        p = np.where(rng.random(600) < 0.4, 0.3, p.round(1))
    elif kind == "edges":
        p = rng.choice([0.0, 0.1, 0.2, 0.3, 0.6, 0.7, 1.0], 600)
    elif kind == "tiny":
        p = np.where(rng.random(600) < 0.5, p * 1e-9, 1 - p * 1e-9)
    y = (rng.random(600) < np.clip(p, 0.1, 0.9)).astype(int)
    rows = scored(spark, p, y).repartition(6)
    found = metrics.compute_metrics(rows).first()
    for name, value in brute(p, y).items():
        assert found[name] == pytest.approx(value, abs=1e-9), name
    assert metrics.expected_calibration_error(rows).first().ece == pytest.approx(found.ece, abs=1e-9)


def test_one_class_only(spark):
    found = metrics.compute_metrics(scored(spark, [0.2, 0.4], [0, 0])).first()
    assert (found.pr_auc, found.roc_auc) == (0.0, None)


def test_reliability_skips_empty_bins(spark):
    found = metrics.reliability_curve(scored(spark, [0.05, 0.1, 0.95], [0, 1, 1])).orderBy("bin").collect()
    assert [(r.bin, r.n, r.prob_true) for r in found] == [(0, 2, 0.5), (9, 1, 1.0)]


def test_threshold(spark):
    found = metrics.with_label(scored(spark, [0.49, 0.5], [0, 1])).orderBy("p").collect()
    assert [r.will_cancel for r in found] == [False, True]


def test_ranges_follow_the_scores(spark):
    rows = spark.range(20_000).select(
        (F.lit(0.33) + F.col("id") * 5e-9).alias("p"), (F.xxhash64("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 2).alias("g")
    )
    scores = metrics.score_table(rows)
    for rows_per_range, least in ((2_000, 8), (200, 80)):
        ranges = ranking.ranges_for(scores.count(), rows_per_range)
        limits = ranking.value_ranges(scores, "p", ranges)[0]
        used = ranking.with_range(scores, "p", limits, "r").groupBy("r").count()
        assert used.count() >= least and used.agg(F.max("count")).first()[0] <= 3 * rows_per_range
    one, many = (metrics.compute_metrics(rows, keys=["g"], rows_per_range=n).orderBy("g").collect() for n in (10**6, 200))
    for a, b in zip(one, many):
        assert [a[c] for c in a.__fields__] == pytest.approx([b[c] for c in b.__fields__])
