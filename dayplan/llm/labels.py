"""Bounded samples of labelled documents, held-out folds and a small logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000  # labelled rows that a model is fitted on, at most


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, doc_id: str = "doc_id", text: str = "text",
    rows: int = SAMPLE_ROWS, extra: list[str] | None = None,
) -> DataFrame:
    """(doc_id, text, label, half, and columns ``extra`` as doubles) of at most ``rows`` labelled documents that ``learn`` allows.

    The ids are chosen by hash before any text is read; they are bounded by ``rows``, so they are
    broadcast and the documents do not move. A document with several labels takes the largest;
    other labels than 0 and 1 do not count.
    """
    chosen = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label"))
        .where("_id is not null and label in (0, 1)").groupBy("_id").agg(F.max("label").alias("label"))
        .withColumnRenamed("_id", doc_id).where(learn).orderBy(F.xxhash64(doc_id), doc_id).limit(rows)
        .withColumnRenamed(doc_id, "_id")
    )
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       *[F.col(c).cast("double").alias(c) for c in extra or []])
    return read.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).withColumn(
        "half", (F.abs(F.xxhash64("doc_id", F.lit("half"))) % 2).cast("int")
    ).select("doc_id", "text", "label", "half", *(extra or []))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights (bias first) of a ridge logistic regression, by damped Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * (penalty * w * w).sum())

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), slope)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        fresh = loss(w - size * step)
        if now - fresh < 1e-9 * max(1.0, abs(now)):
            break
        w, now = w - size * step, fresh
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
