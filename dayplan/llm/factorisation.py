"""Text quality by a factorisation machine.

A text is a sparse vector: its different words, hashed into buckets, structure statistics cut into
quantile bins, and binned numbers of the document (metadata). The model is a logistic one with a
weight per feature and an interaction of low rank for every pair of features. All pairs together
cost one pass over the features: half of (sum of factors)^2 minus the sum of squared factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayplan.llm import labels as lab
from dayplan.llm.shared import Scratch, Words, pieces

BUCKETS = 1 << 16
FACTORS = 8
BINS = 10
STATISTICS = 14
SAMPLE_WORDS = 1 << 22  # different words per text, summed over the labelled texts that a model is fitted on, at most


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of the different words of each row, and their number per row."""
    key = np.unique((words.row.astype(np.uint64) << np.uint64(40)) | (words.hash >> np.uint64(24)))
    row = (key >> np.uint64(40)).astype(np.int64)
    return row, (key % np.uint64(BUCKETS)).astype(np.int64), np.bincount(row, minlength=words.rows)


def statistics(words: Words, different: np.ndarray) -> np.ndarray:
    """Structure of each row: sizes, shares of kinds of characters, repetition."""
    data, ends = words.data, words.offsets
    size = np.diff(ends).astype(np.float64)
    out = np.zeros((words.rows, STATISTICS))

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[ends[1:]] - total[ends[:-1]]).astype(np.float64)

    upper, lower = per_row((data >= 65) & (data <= 90)), per_row((data >= 97) & (data <= 122))
    digits, wide = per_row((data >= 48) & (data <= 57)), per_row(data >= 128)
    space, lines = per_row((data == 32) | ((data >= 9) & (data <= 13))), per_row(data == 10)
    signs = size - upper - lower - digits - wide - space
    dots, bars, bangs = per_row((data == 46) | (data == 44)), per_row(data == 124), per_row(data == 33)
    odd = per_row(np.isin(data, np.frombuffer(b"#$%&*<>{}[]\\^_~=", np.uint8)))
    n = words.counts().astype(np.float64)
    letters = np.bincount(words.row, weights=words.end - words.start, minlength=words.rows)
    some = np.maximum(size, 1)
    for k, values in enumerate((
        np.log1p(size), np.log1p(n), letters / np.maximum(n, 1), upper / np.maximum(upper + lower, 1), digits / some,
        wide / some, space / some, signs / some, dots / np.maximum(n, 1), bars / np.maximum(n, 1), bangs / np.maximum(n, 1),
        odd / np.maximum(n, 1), n / (lines + 1), different / np.maximum(n, 1),
    )):
        out[:, k] = values
    return out


@dataclass
class QualityModel:
    edges: list[np.ndarray]  # inner bin edges of every number
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def bins(self, numbers: np.ndarray) -> np.ndarray:
        """Feature of every number of every row; the last bin of a number is for missing ones."""
        out = np.empty(numbers.shape, np.int64)
        for k, edge in enumerate(self.edges):
            place = np.searchsorted(edge, numbers[:, k], side="right")
            out[:, k] = BUCKETS + k * (BINS + 1) + np.where(np.isnan(numbers[:, k]), BINS, place)
        return out

    def score(self, row: np.ndarray, bucket: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        rows = len(numbers)
        row, feature, value = vectors(row, bucket, self.bins(numbers))
        z = self.bias + np.bincount(row, weights=self.weight[feature] * value, minlength=rows)
        for f in range(self.factor.shape[1]):
            part = self.factor[feature, f] * value
            z += 0.5 * (np.bincount(row, weights=part, minlength=rows) ** 2
                        - np.bincount(row, weights=part * part, minlength=rows))
        return lab.sigmoid(z)


def vectors(row: np.ndarray, bucket: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: words share a length of 1, each number has a feature of value 1/2."""
    rows = len(bins)
    share = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=rows), 1))
    return (np.concatenate([row, np.repeat(np.arange(rows), bins.shape[1])]), np.concatenate([bucket, bins.ravel()]),
            np.concatenate([share[row], np.full(bins.size, 0.5)]))


def train(
    row: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray, features: int, factors: int = FACTORS,
    epochs: int = 12, rate: float = 0.1, ridge: float = 2e-5, batch: int = 128, seed: int = 5,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by minibatch Adagrad; rows sorted, the same for the same input."""
    rng = np.random.default_rng(seed)
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    bias, w = float(np.log(share / (1 - share))), np.zeros(features)
    v = rng.normal(0, 0.02, (features, factors))
    past_w, past_v = np.full(features, 1e-4), np.full((features, factors), 1e-4)
    first = np.searchsorted(row, np.arange(len(y) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            docs = order[at : at + batch]
            size = first[docs + 1] - first[docs]
            who = np.repeat(np.arange(len(docs)), size)
            place = np.arange(len(who)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[docs], size)
            f, x = feature[place], value[place]
            part = v[f] * x[:, None]
            edge = np.cumsum(size) - size
            total = np.add.reduceat(part, edge, axis=0)
            z = bias + np.add.reduceat(w[f] * x, edge) + 0.5 * (total**2 - np.add.reduceat(part**2, edge, axis=0)).sum(1)
            miss = (lab.sigmoid(z) - y[docs]) / len(docs)
            bias -= rate * float(miss.sum())
            used, which = np.unique(f, return_inverse=True)
            g = np.bincount(which, weights=miss[who] * x) + ridge * w[used]
            past_w[used] += g * g
            w[used] -= rate * g / np.sqrt(past_w[used])
            slope = (miss[who] * x)[:, None] * (total[who] - part)
            g = np.stack([np.bincount(which, weights=slope[:, k]) for k in range(factors)], 1) + ridge * v[used]
            past_v[used] += g * g
            v[used] -= 0.5 * rate * g / np.sqrt(past_v[used])
    return bias, w, v


def _numbers(batch: pa.RecordBatch, words: Words, different: np.ndarray, metadata: list[str]) -> np.ndarray:
    extra = [
        batch.column(batch.schema.get_field_index(c)).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in metadata
    ]
    return np.column_stack([statistics(words, different), *extra])


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, doc_id: str = "doc_id",
    text: str = "text", metadata: list[str] | None = None, rows: int = lab.SAMPLE_ROWS, most_words: int = SAMPLE_WORDS,
) -> QualityModel:
    """Fit on the features of at most ``rows`` labelled documents that ``learn`` allows.

    They are taken in order of a hash while their different words add up to ``most_words`` at most,
    so what reaches the driver has a bound in bytes however long the texts are: two bytes a word.
    ``metadata`` are numeric columns of ``docs``; null is a bin of its own. Without labels of both
    kinds every text scores the share of label 1 (0.5 if there is none).
    """
    metadata = metadata or []
    chosen = lab.sample(docs, labels, label, F.lit(True) if learn is None else learn, doc_id, text, rows, metadata)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                words = Words(batch.column(batch.schema.get_field_index("text")))
                row, bucket, different = word_features(words)
                edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
                packed = bucket.astype("<u2").tobytes()
                numbers = _numbers(batch, words, different, metadata).astype("<f8")
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(batch.schema.get_field_index(c)) for c in ("key", "label")], pa.array(np.diff(edges)),
                     pa.array([packed[2 * a : 2 * b] for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
                     pa.array([n.tobytes() for n in numbers], pa.binary())],
                    names=["key", "label", "size", "buckets", "numbers"])

    stored = Scratch(docs.sparkSession, "quality").write(
        chosen.withColumn("key", F.xxhash64("doc_id", "text"))
        .mapInArrow(features, "key bigint, label int, size bigint, buckets binary, numbers binary"), "features")
    sizes = stored.select("key", "size").toPandas().sort_values("key", ignore_index=True)  # at most ``rows``
    fits = sizes["key"][sizes["size"].cumsum() <= most_words]
    found = stored.where(F.col("key") <= int(fits.iloc[-1])) if len(fits) else stored.limit(0)
    found = found.toArrow().combine_chunks().sort_by([("key", "ascending"), ("size", "ascending")])
    y = found["label"].to_numpy().astype(np.float64)
    size = BUCKETS + (STATISTICS + len(metadata)) * (BINS + 1)
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        edges = [np.zeros(0)] * (STATISTICS + len(metadata))
        return QualityModel(edges, float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, FACTORS)))
    numbers = np.frombuffer(b"".join(found["numbers"].to_pylist()), "<f8").reshape(len(y), -1)
    edges = [np.unique(np.quantile(c[~np.isnan(c)], np.arange(1, BINS) / BINS)) if (~np.isnan(c)).any() else np.zeros(0)
             for c in numbers.T]
    bins = QualityModel(edges, 0.0, np.zeros(0), np.zeros((0, 0))).bins(numbers)
    bias, w, v = train(*_laid_out(found["size"].to_numpy(), found["buckets"], bins), y, size)
    return QualityModel(edges, bias, w.astype(np.float32), v.astype(np.float32))


def _laid_out(sizes: np.ndarray, buckets: pa.ChunkedArray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``vectors`` gives, row after row and in small types: each row's words, then its numbers."""
    rows, extra = bins.shape
    row = np.repeat(np.arange(rows, dtype=np.int32), sizes + extra)
    word = np.ones(len(row), bool)
    ends = np.cumsum(sizes + extra)
    for k in range(1, extra + 1):
        word[ends - k] = False
    feature = np.empty(len(row), np.int32)
    feature[~word] = bins.ravel()
    feature[word] = np.frombuffer(b"".join(buckets.to_pylist()), "<u2")
    value = np.full(len(row), 0.5, np.float32)
    value[word] = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
    return row, feature, value


def score_quality(
    docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text", metadata: list[str] | None = None,
) -> DataFrame:
    """(doc_id, score) of every row, from its whole text; a null text is scored as an empty one."""
    metadata = metadata or []
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"m{k}" for k in range(len(metadata))]
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       *[F.col(c).cast("double").alias(n) for c, n in zip(metadata, names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                words = Words(batch.column(1))
                row, bucket, different = word_features(words)
                score = shared.value.score(row, bucket, _numbers(batch, words, different, names))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(run, f"doc_id {kind}, score double")
