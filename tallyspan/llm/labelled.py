"""Labels for learning: which rows are held out, and the labels joined to the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels that a broadcast may hold at most (about 16 bytes each).
BROADCAST_LABELS = 1 << 20


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(doc_id.cast("long").cast("string").cast("binary")), F.lit(folds)).cast("int")


def with_label(documents: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``doc_id, text, label`` of the documents that have a label 0 or 1.

    An id with both labels counts as 1. Rows without an id have no label.
    """
    given = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    small = labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return documents.join(F.broadcast(given) if small else given, "doc_id")


def logistic(features, label, weight, ridge: float = 1e-3, rounds: int = 60):
    """Weighted logistic regression by Newton's method: coefficients, the last one constant."""
    import numpy as np

    x = np.column_stack((features, np.ones(len(features))))
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - label)) + ridge * 1e-2 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
    return w
