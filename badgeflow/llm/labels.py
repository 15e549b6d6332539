"""Labelled documents for training, as a bounded sample."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a model is trained on at most, and characters of a text that takes part. Whole texts are used;
#: longer ones are not in the sample. Scoring has no such bounds.
MAX_DOCS = 4000
MAX_CHARS = 30_000
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS
) -> tuple[list[str], np.ndarray]:
    """Texts and 0/1 labels of up to max_docs labelled rows that are not held out, chosen by a hash of the id.

    Rows without an id, a text or a label of 0 or 1 are left out; a document with several labels counts as
    labelled 1 if one of them is; of several texts of one document the first in sort order is taken.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    )
    rows = (
        docs.where(F.length("text") <= max_chars).select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most max_docs rows
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
        .collect()
    )
    rows.sort(key=lambda r: zlib.crc32(str(r.doc_id).encode()))
    return [r.text for r in rows], np.array([r.y for r in rows], np.int64)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights of the columns of x, by Newton's method; without both labels, only the base rate."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = logistic(x @ w)
        slope = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(slope, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -3, 3)
    return w
