"""Labelled rows: held-out folds, bounded training samples, calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Fold 0 by crc32 of the id as text; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(labels: DataFrame, label: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out fold, those with the
    smallest hashes: (id, ``__label``). Repeated labels count once (the smaller)."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id_col)))
    return (known.groupBy(id_col).agg(F.min(F.col(label).cast("int")).alias("__label"))
            .orderBy(F.xxhash64(id_col, F.lit(11)), id_col).limit(rows))


def sampled_documents(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str, text_col: str) -> DataFrame:
    """The sample's documents: id, ``__text``, ``__label``. The ids are at most
    ``rows`` and so are broadcast. Rows that repeat an id count as one, the text
    with the smallest hash, so the sample stays bounded whatever repeats."""
    sample = training_sample(labels, label, rows, id_col).withColumnRenamed(id_col, "__id")
    found = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
             .join(F.broadcast(sample), "__id"))
    return (found.groupBy("__id").agg(F.min(F.struct(F.xxhash64("__text").alias("h"), "__text", "__label")).alias("r"))
            .select("__id", "r.__text", "r.__label"))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_calibration(raw: np.ndarray, label: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and shift of a logistic curve from raw values to probabilities,
    by damped Newton steps with a little shrinkage."""
    if len(raw) == 0:
        return 0.0, 0.0
    x = np.stack([raw, np.ones(len(raw))], 1)
    w = np.zeros(2)
    ridge = np.diag([1e-3 * len(raw) ** 0.5, 1e-6])
    for _ in range(steps):
        p = logistic(x @ w)
        slope = x.T @ (p - label) + ridge @ w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
    return float(w[0]), float(w[1])
