"""Labelled rows for the classifiers: which rows may teach, and a bounded sample of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyferry.llm.common import stored


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the doc_id as text (null: empty), modulo `folds`."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def training_texts(documents: DataFrame, labels: DataFrame, column: str, held_out_fold: int,
                   max_rows: int | None, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """text, label of the labelled rows outside the held-out fold.

    A document labelled more than once takes its largest label; null labels do
    not count. `max_rows` bounds the sample: ids with the smallest hashes.
    """
    ids = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != held_out_fold))
    ids = ids.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    if max_rows is not None:
        ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    ids = stored(ids.select(F.col("doc_id").alias("label_id"), "label"), "label-ids")
    if ids.count() * 16 <= broadcast_bytes:  # two numbers a row
        ids = F.broadcast(ids)
    return documents.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("label_id")).select("text", "label")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a small logistic regression (Newton steps); the last is the constant's."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
