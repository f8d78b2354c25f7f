"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; unlabelled are documents whose labels are not looked at. With the class
prior p (the share of good documents among labelled ones), R_p+ and R_p- the mean logistic loss of the positives as good
and as bad, and R_u- that of the unlabelled as bad, the risk is p R_p+ + max(0, R_u- - p R_p-). Where the second part,
which estimates the risk of the bad documents, falls below zero, the step goes the other way, as it then only fits noise.

Features are shapes: frequencies of one to three neighbouring characters after small and capital letters and digits have
been made one character each, hashed to BUCKETS, and the numbers of words, lines and repeated words and lines.

The classifier is fitted on bounded samples (POSITIVES and UNLABELLED rows), the prior on all labels outside the held-out
fold; scores cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchflow.llm.common import crc_fold, let_go, map_columns, python_crc_fold
from matchflow.llm.linear import bounded_sample, descend, sigmoid

FOLDS, HELD_OUT = 5, 0
POSITIVES = 5_000
UNLABELLED = 10_000
THRESHOLD = 0.3
PENALTY = 1e-3
BUCKETS_LOG = 10
EXTRA = 5
SHAPES = np.array([ord("0") if chr(i).isdigit() and i < 128 else ord("A") if 65 <= i <= 90 else ord("a") if 97 <= i <= 122 or i >= 128 else i for i in range(256)], np.uint32)


def features(text: str) -> np.ndarray:
    """Feature vector of a whole text."""
    data = text.encode()
    shape = SHAPES[np.frombuffer(data, np.uint8)]
    parts = [shape, shape[:-1] * np.uint32(257) + shape[1:], shape[:-2] * np.uint32(66_049) + shape[1:-1] * np.uint32(257) + shape[2:]]
    hashed = np.concatenate(parts[: max(1, min(3, len(shape)))]) * np.uint32(2_654_435_761) >> np.uint32(32 - BUCKETS_LOG)
    counts = np.bincount(hashed.astype(np.int64), minlength=1 << BUCKETS_LOG)
    words, lines = data.split(), data.split(b"\n")
    extra = [np.log1p(len(data)), np.log1p(len(words)), len(set(words)) / max(len(words), 1), len(set(lines)) / len(lines), np.log1p(len(data) / max(len(words), 1))]
    return np.concatenate([np.sqrt(counts / max(len(data), 1)), extra])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(np.clip((rows - self.mean) / self.scale, -6, 6) @ self.weights + self.intercept)


def non_negative_gradient(positive: np.ndarray, unlabelled: np.ndarray, prior: float):
    """Gradient of the non-negative risk by weights and intercept."""

    def gradient(weights: np.ndarray, intercept: float) -> tuple[np.ndarray, float]:
        narrow = weights.astype(positive.dtype)  # else each product would widen a copy of the sample
        p, u = positive @ narrow + intercept, unlabelled @ narrow + intercept
        as_bad_p, as_bad_u = prior * sigmoid(p) / len(p), sigmoid(u) / len(u)
        if np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean() >= 0:
            by_p, by_u = -prior * (1 - sigmoid(p)) / len(p) - as_bad_p, as_bad_u
        else:
            by_p, by_u = as_bad_p, -as_bad_u
        by_weight = positive.T @ by_p.astype(positive.dtype) + unlabelled.T @ by_u.astype(positive.dtype)
        return by_weight.astype(np.float64), by_p.sum() + by_u.sum()

    return gradient


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    """Fit on rows outside the held-out fold.

    Labels that are null, or whose doc_id is null, do not count; of several labels of one document the largest does.
    Of several texts of one document one counts, so that the driver gets a row per id and no more. Without positives or
    without documents the score is the prior everywhere (1/2 without any label).
    """
    outside = crc_fold("doc_id", folds) != held_out
    known = labels.where(outside & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    prior = known.agg(F.avg((F.col("quality") == 1).cast("double")).alias("p")).first()["p"]
    prior = 0.5 if prior is None else prior
    good = bounded_sample(known.where("quality = 1").select("doc_id"), "doc_id", positives)
    any_ = bounded_sample(docs.where(outside).select("doc_id").distinct(), "doc_id", unlabelled)
    p, u = (_vectors(docs.join(F.broadcast(ids), "doc_id")) for ids in (good, any_))
    if len(p) == 0 or len(u) == 0:
        odds = np.log(prior / (1 - prior)) if 0 < prior < 1 else 40.0 * (2 * prior - 1)
        width = (1 << BUCKETS_LOG) + EXTRA
        return Model(np.zeros(width), np.ones(width), np.zeros(width), float(odds))
    mean, scale = u.mean(axis=0), u.std(axis=0) + 1e-3
    for x in (p, u):  # in place: the driver holds each sample once
        x -= mean
        x /= scale
        np.clip(x, -6, 6, out=x)
    weights, intercept = descend(non_negative_gradient(p, u, prior), len(mean), PENALTY)
    return Model(mean, scale, weights, intercept)


def _vectors(docs: DataFrame) -> np.ndarray:
    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        let_go()
        for ids, texts in batches:
            yield {"doc_id": ids, "x": [zstandard.compress(features(t or "").astype(np.float32).tobytes()) for t in texts]}

    rows = map_columns(docs, ["doc_id", "text"], work, "doc_id bigint, x binary").groupBy("doc_id").agg(F.min("x").alias("x")).collect()
    rows = sorted((r["doc_id"], bytes(r["x"])) for r in rows)
    out = np.empty((len(rows), (1 << BUCKETS_LOG) + EXTRA), np.float32)
    for i, (_, packed) in enumerate(rows):
        out[i] = np.frombuffer(zstandard.decompress(packed), np.float32)
    return out


def score(docs: DataFrame, model: Model, folds: int = FOLDS, held_out: int = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """Columns doc_id, held_out, score and predicted of every row; null texts count as empty, a null id is not held out.

    Repeated rows get a row each; other columns are ignored; an empty table gives no rows. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        for ids, texts in batches:
            scores = np.concatenate([shared.value.score(np.stack([features(t or "") for t in texts[i : i + 256]])) for i in range(0, len(texts), 256)])
            fold = [i is not None and python_crc_fold(i, folds) == held_out for i in ids]
            yield {"doc_id": ids, "held_out": fold, "score": scores.tolist(), "predicted": (scores >= threshold).astype(int).tolist()}

    return map_columns(docs, ["doc_id", "text"], work, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def good(texts):
        let_go()
        return texts.map(lambda t: float(shared.value.score(features(t or "")[None, :])[0])).astype("float64")

    return docs.where(good(F.col("text")) >= threshold)
