"""Bounded labelled samples and logistic calibration, shared by the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import small_batches


def labelled(docs: DataFrame, labels: DataFrame, column: str, wanted, rows: int, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(key, y, text) of at most `rows` labelled rows that `wanted` admits, the first by the md5 of the key.

    Labels other than 0 and 1 and null keys are left out. The sample of labels is bounded, so it is broadcast.
    """
    picked = (labels.where(F.col(key).isNotNull() & F.col(column).isin(0, 1) & wanted)
              .select(F.col(key).alias("_key"), F.col(column).cast("int").alias("y"))
              .orderBy(F.md5(F.col("_key").cast("string")), "_key", "y").limit(rows))
    return (small_batches(docs).select(F.col(key).alias("key"), F.col(text).alias("text"))
            .join(F.broadcast(picked), F.col("key") == F.col("_key")).select("key", "y", "text"))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[list[float], list[float], list[float]]:
    """Mean and scale of each column, and the weights with the constant last, by Newton steps with a ridge.

    Without rows all scores are 0.5; with one label only they tend to that label. The constant's pull is one row.
    """
    if not len(x):
        return [0.0] * x.shape[1], [1.0] * x.shape[1], [0.0] * (x.shape[1] + 1)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w, pull = np.zeros(z.shape[1]), np.diag([ridge] * x.shape[1] + [0.25])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pull, z.T @ (p - y) + pull @ w)
        size = np.abs(step).max()
        w -= step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return mean.tolist(), scale.tolist(), w.tolist()


def probability(model, x) -> float:
    mean, scale, w = model
    z = w[-1] + sum(wi * (xi - m) / s for wi, xi, m, s in zip(w, x, mean, scale))
    return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
