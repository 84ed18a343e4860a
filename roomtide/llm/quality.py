"""Quality classifier by positive-unlabelled learning.

Trusted positives (quality 1) and unlabelled web text train a logistic model g. With the class
prior p, the unbiased risk is p E_P[l(g)] + E_U[l(-g)] - p E_P[l(-g)], l the logistic loss; the
part after the first term estimates the risk on negatives and cannot be negative, so where it
drops below zero a step is taken that raises it again (non-negative risk). The prior is
estimated as the share of positives among the labelled rows that may be learned from.

Features describe a text's form and nothing else: shares of letters, capitals, digits, marks
and separators, word lengths, repeated words and runs. They are read from the whole text, in
one numpy pass over its bytes. Labels, language, source and id never enter them.

Fitting takes at most ``fit_rows`` positives and ``fit_rows`` unlabelled rows (the rows with
the smallest hash of the id; a documented bound); every row of the table is scored.

Cases: a null text counts as empty and has the features of an empty text; a document with
several labels counts as positive if any of them is 1; labels without a document and documents
without an id teach nothing; repeated rows are scored each; with no positive or no unlabelled
row the score is the prior (0.5 without labels); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomtide.llm.common import map_batches, shared, white, word_hashes, word_spans


@dataclass(frozen=True)
class Settings:
    fit_rows: int = 20_000  # bound of the sample of each kind
    steps: int = 400
    rate: float = 0.5
    ridge: float = 1e-4
    slack: float = 0.0  # how far the estimated negative risk may drop below zero
    threshold: float = 0.3


FEATURES = 16


def byte_classes() -> np.ndarray:
    """0 lower letter, 1 capital, 2 digit, 3 sentence mark, 4 other mark, 5 white space, 6 byte of a longer character."""
    kind = np.full(256, 4, np.int64)
    kind[97:123], kind[65:91], kind[48:58] = 0, 1, 2
    kind[[ord(c) for c in ".,;:?'\"-()"]] = 3
    kind[white()] = 5
    kind[128:] = 6
    return kind


def text_features(text: str | None, kind: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """A fixed number of shares and logarithms; all zero but the bias for a text without words."""
    out = np.zeros(FEATURES)
    out[0] = 1.0
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    starts, ends = word_spans(data, apart)
    n = len(starts)
    if n == 0:
        return out
    counts = np.bincount(kind[data], minlength=7)
    solid = max(1, len(data) - counts[5])
    words = word_hashes(data, starts, ends)
    lengths = ends - starts
    first, last = kind[data[starts]], kind[data[ends - 1]]
    alone = (lengths == 1) & (first == 4)
    distinct, often = np.unique(words, return_counts=True)
    out[1:5] = counts[[1, 2, 3, 4]] / solid
    out[5] = np.log1p(n) / 10
    out[6] = len(distinct) / n
    out[7] = often.max() / n
    out[8] = (words[1:] == words[:-1]).mean() if n > 1 else 0.0
    out[9] = alone.mean()
    out[10] = (last == 4).mean()
    out[11] = (first == 1).mean()
    out[12] = (last == 3).mean()
    out[13] = np.log1p(lengths.mean()) / 5
    out[14] = (lengths <= 3).mean()
    out[15] = np.sqrt(counts[4] / solid)
    return out


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id has the checksum of an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, settings: Settings) -> np.ndarray:
    """Weights that minimise the non-negative risk, on standardised features; they fold the scaling back."""
    mean, spread = unlabelled.mean(0), unlabelled.std(0) + 1e-9
    mean[0], spread[0] = 0.0, 1.0
    p, u = (positive - mean) / spread, (unlabelled - mean) / spread
    w, speed = np.zeros(p.shape[1]), np.zeros(p.shape[1])
    for _ in range(settings.steps):
        gp, gu = p @ w, u @ w
        loss_minus = lambda g: np.logaddexp(0, g)  # noqa: E731  the loss of calling a row negative
        negative_risk = loss_minus(gu).mean() - prior * loss_minus(gp).mean()
        down = u.T @ sigmoid(gu) / len(u) - prior * (p.T @ sigmoid(gp)) / len(p)
        if negative_risk < -settings.slack:
            step = -down
        else:
            step = prior * (p.T @ (sigmoid(gp) - 1)) / len(p) + down
        step = step + settings.ridge * np.concatenate(([0.0], w[1:]))
        speed = 0.9 * speed - settings.rate * step
        w = w + speed
    out = w / spread
    out[0] = w[0] - (w[1:] * mean[1:] / spread[1:]).sum()
    return out


def featured(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id and the features of every row."""

    def work(batch: pa.RecordBatch):
        kind, apart = byte_classes(), white()
        rows = np.array([text_features(t, kind, apart) for t in batch.column(1).to_pylist()]).reshape(-1, FEATURES)
        values = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, FEATURES, dtype=np.int32), pa.array(rows.astype(np.float32).ravel()))
        return [batch.column(0), values]

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(kept, work, "doc_id bigint, features array<float>")


def sample(rows: DataFrame, bound: int) -> np.ndarray:
    """Features of the ``bound`` rows with the smallest hash of their id."""
    picked = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).select("features").toArrow()
    flat = picked.column(0).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, FEATURES)


def score_quality(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), text: str = "text", doc_id: str = "doc_id", folds: int = 5
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; rows whose fold is 0 teach nothing."""
    rows = shared(featured(docs, text, doc_id), "features")
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    marks = marks.where(fold("doc_id", folds) != 0)
    share = marks.agg(F.avg(F.col("quality").cast("double")).alias("p")).first()["p"]
    prior = 0.5 if share is None else min(0.99, max(0.01, float(share)))
    teach = rows.where(F.col("doc_id").isNotNull() & (fold("doc_id", folds) != 0))
    trusted = marks.where("quality = 1").select("doc_id")
    positive = sample(teach.join(trusted, "doc_id", "left_semi"), settings.fit_rows)
    unlabelled = sample(teach, settings.fit_rows)  # web text as it comes, whatever its label
    if len(positive) and len(unlabelled):
        weights = fit(positive, unlabelled, prior, settings)
    else:
        weights = np.zeros(FEATURES)
        weights[0] = np.log(prior / (1 - prior))

    def work(batch: pa.RecordBatch):
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, FEATURES)
        return [batch.column(0), pa.array(sigmoid(flat @ weights))]

    scored = map_batches(rows, work, "doc_id bigint, score double")
    return scored.select(
        "doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted")
    )
