"""Toxicity: a linear classifier over character n-grams that are scaled by naive Bayes log-count ratios.

A feature says whether a text has an n-gram of 4 to 6 bytes (lower case), hashed to 2^BUCKETS_LOG. Its value is the log of
the ratio of the smoothed shares of toxic and clean training texts that have it; a logistic regression with a penalty
learns the weights. Only the FEATURES n-grams that tell the classes apart most clearly have a weight.

Ratios and weights are fitted on a bounded sample of TRAINING labelled rows outside the held-out fold; the n-grams are
counted where the texts lie, and only counts, and for the chosen n-grams their occurrences, are brought together. Scores
cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchflow.llm.common import crc_fold, map_columns, python_crc_fold
from matchflow.llm.linear import bounded_sample, descend, sigmoid

FOLDS, HELD_OUT = 4, 2
TRAINING = 20_000
FEATURES = 8192
ORDERS = (4, 5, 6)
BUCKETS_LOG = 18
THRESHOLD = 0.3
PENALTY = 1e-4
PIECE = 1 << 20
WHITE = np.uint64(0x9E3779B97F4A7C15)
PRIME = np.uint64(0x100000001B3)

_last = np.zeros(0, np.int64)


def grams(text: str) -> np.ndarray:
    """Distinct buckets of a whole text's n-grams; long texts are taken in overlapping pieces."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    found = [_distinct(_hashed(data[i : i + PIECE + max(ORDERS) - 1])) for i in range(0, max(len(data), 1), PIECE)]
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def _hashed(data: np.ndarray) -> np.ndarray:
    wide, out = data.astype(np.uint64) + np.uint64(1), []
    for n in ORDERS:
        if len(data) >= n:
            h = np.zeros(len(data) - n + 1, np.uint64)
            for i in range(n):
                h = h * PRIME + wide[i : len(data) - n + 1 + i]
            out.append((h * WHITE >> np.uint64(64 - BUCKETS_LOG)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _distinct(buckets: np.ndarray) -> np.ndarray:
    """Each bucket once: the last place written to a bucket's slot is the one that counts."""
    global _last
    if len(_last) == 0:
        _last = np.zeros(1 << BUCKETS_LOG, np.int64)
    places = np.arange(len(buckets))
    _last[buckets] = places
    return buckets[_last[buckets] == places]


@dataclass
class Model:
    """Weight times ratio of every bucket, and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        return float(sigmoid(np.array(self.weights[grams(text)].sum() + self.intercept)))


def fit(docs: DataFrame, labels: DataFrame, training: int = TRAINING, n_features: int = FEATURES, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    """Fit on labelled rows outside the held-out fold.

    Labels that are null, or whose doc_id is null, do not count; of several labels of one document the largest does. Of
    several texts of one document all count for the ratios and one for the weights, so that the driver gets a row per id and no more. If
    only one class is there, the score is its share of all training rows (1/2 without any).
    """
    known = labels.where((crc_fold("doc_id", folds) != held_out) & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("toxic"))
    chosen = bounded_sample(known, "doc_id", training)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    spread = rows.groupBy("toxic").count().collect()
    sizes = {r["toxic"]: r["count"] for r in spread}
    bad, clean = sizes.get(1, 0), sizes.get(0, 0)
    if bad == 0 or clean == 0:
        share = 0.5 if bad + clean == 0 else bad / (bad + clean)
        return Model(np.zeros(1 << BUCKETS_LOG), 40.0 * (2 * share - 1))
    a, b = F.col("bad") / bad, F.col("clean") / clean
    clear = F.abs(a - b) / F.sqrt((F.col("bad") + F.col("clean") + 1) / (bad + clean) * (1 / bad + 1 / clean))
    table = _counts(rows).groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("clean").alias("clean"))
    best = table.orderBy(F.desc(clear), "bucket").limit(n_features).toPandas()
    ratio = np.log((best["bad"].to_numpy() + 1) / (bad + 2)) - np.log((best["clean"].to_numpy() + 1) / (clean + 2))
    number = np.full(1 << BUCKETS_LOG, -1, np.int64)
    number[best["bucket"].to_numpy()] = np.arange(len(best))
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        for ids, texts, toxic in batches:
            found = [shared.value[grams(t or "")] for t in texts]
            yield {"doc_id": ids, "toxic": toxic, "has": [x[x >= 0].astype("<i4").tobytes() for x in found]}

    data = map_columns(rows, ["doc_id", "text", "toxic"], work, "doc_id bigint, toxic int, has binary")
    data = data.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("has").alias("has")).toPandas()
    data = data.assign(has=data["has"].map(bytes)).sort_values("doc_id")
    has = [np.frombuffer(x, "<i4").astype(np.int64) for x in data["has"]]
    weights, intercept = _regression(has, data["toxic"].to_numpy(float), ratio)
    whole = np.zeros(1 << BUCKETS_LOG)
    whole[best["bucket"].to_numpy()] = weights * ratio
    return Model(whole, intercept)


def _counts(rows: DataFrame) -> DataFrame:
    """Columns bucket, bad and clean: texts of either class that have an n-gram of the bucket, summed per task."""

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        counts = np.zeros((2, 1 << BUCKETS_LOG), np.int64)
        for texts, toxic in batches:
            for text, t in zip(texts, toxic):
                counts[t, grams(text or "")] += 1
        used = np.flatnonzero(counts.any(axis=0))
        for part in np.array_split(used, max(1, len(used) // 10_000)):
            yield {"bucket": part.tolist(), "bad": counts[1, part].tolist(), "clean": counts[0, part].tolist()}

    return map_columns(rows, ["text", "toxic"], work, "bucket bigint, bad bigint, clean bigint")


def _regression(has: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression over the ratios of the features that a text has."""
    feature, text = np.concatenate(has), np.repeat(np.arange(len(has)), [len(x) for x in has])

    def gradient(weights: np.ndarray, intercept: float) -> tuple[np.ndarray, float]:
        margin = np.bincount(text, weights=(weights * ratio)[feature], minlength=len(has)) + intercept
        off = (sigmoid(margin) - toxic) / len(toxic)
        return np.bincount(feature, weights=off[text], minlength=len(ratio)) * ratio, off.sum()

    return descend(gradient, len(ratio), PENALTY, rounds=300)


def score(docs: DataFrame, model: Model, folds: int = FOLDS, held_out: int = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """Columns doc_id, held_out, score and predicted of every row; null texts count as empty, a null id is not held out.

    Repeated rows get a row each; other columns are ignored; an empty table gives no rows. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[list[list]]) -> Iterator[dict]:
        for ids, texts in batches:
            scores = [shared.value.score(t or "") for t in texts]
            fold = [i is not None and python_crc_fold(i, folds) == held_out for i in ids]
            yield {"doc_id": ids, "held_out": fold, "score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return map_columns(docs, ["doc_id", "text"], work, "doc_id bigint, held_out boolean, score double, predicted int")
