"""Hard negatives by the threshold algorithm over sorted lists.

Vectors become integers and are cut, in order of label and id, into shards of equal size. A shard
file holds its vectors and, for each dimension, its rows in order of that component. For an anchor
the lists are read from the end its component points to (sorted access); every row met is scored by
its whole integer inner product (random access). No row that is not met yet can score more than the
threshold, the sum over dimensions of the anchor's component times the last value read. A shard is
left once the threshold is strictly below the last place of every window, or below the window.

An anchor keeps its windows from shard to shard, so later shards are left earlier. Blocks of anchors
are spread over tasks; a task holds one shard at a time and reads only shards whose labels matter.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayplan.llm.files import locate, new_file, open_file
from dayplan.llm.shared import Scratch
from dayplan.operators.dense_index import dense_index
from dayplan.session import task_count

SHARD = 8192  # rows of a shard
FIRST = 16  # places of each list read before the threshold is first looked at; then twice as many each time
BLOCK = (16, 1024)  # least and largest number of anchors worked off together
SCALE = 256
WHOLE = np.iinfo(np.int64)


def integer_vectors(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, vec): components floor(256 x) as integers, one row per id.

    Rows without id, label or vector, or with a component that is null or not finite, take no part;
    neither do vectors with a component of 2^23 / sqrt(length) or more, whose scores need not fit 64
    bits. A repeated id counts once, with its least label and vector.
    """
    v = F.col(vector).cast("array<double>")
    limit = F.lit(2.0**31) / F.sqrt(F.greatest(F.size(v), F.lit(1)).cast("double"))
    fits = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * SCALE < limit)), F.lit(False))
    return (
        vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
                       v.alias("vec"), fits.alias("fits"))
        .where("vec_id is not null and label is not null and fits")
        .select("vec_id", "label", F.transform("vec", lambda x: F.floor(x * SCALE).cast("int")).alias("vec"))
        .groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("row")).select("vec_id", "row.label", "row.vec")
    )


def _matrix(lists, width: int, kind: type) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    out = np.zeros((len(lists), width), kind)
    for i, row in enumerate(lists):
        out[i, : len(row)] = row
    return out


@dataclass
class Shard:
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    order: np.ndarray  # per dimension, the rows by ascending component

    @staticmethod
    def build(frame: pd.DataFrame, width: int) -> Shard:
        vectors = _matrix(frame["vec"].tolist(), width, np.int32)
        order = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)
        return Shard(frame["vec_id"].to_numpy(np.int64), frame["label"].to_numpy(np.int64), vectors, np.ascontiguousarray(order))

    def save(self, folder: str, partition: int) -> str:
        name, sink = new_file(folder, partition)
        with sink:
            body = io.BytesIO()
            np.savez(body, ids=self.ids, labels=self.labels, vectors=self.vectors, order=self.order)
            sink.write(body.getvalue())
        return name

    @staticmethod
    def load(folder: str, name: str, kind: type) -> Shard:
        with open_file(folder, name) as source:
            held = np.load(io.BytesIO(source.read()))
        return Shard(held["ids"], held["labels"], held["vectors"].astype(kind), held["order"])


class Windows:
    """The first ``top`` rows by score, then id, between two scores, for several pairs of scores at once."""

    def __init__(self, bounds: list[tuple[int, int]], top: int):
        self.bounds, self.top = bounds, top
        self.scores = [np.zeros(0, np.int64) for _ in bounds]
        self.ids = [np.zeros(0, np.int64) for _ in bounds]

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w, (low, high) in enumerate(self.bounds):
            least = max(low, int(self.scores[w][-1])) if len(self.scores[w]) == self.top else low
            into = (scores >= least) & (scores <= high)
            if into.any():
                s, i = np.concatenate([self.scores[w], scores[into]]), np.concatenate([self.ids[w], ids[into]])
                best = np.lexsort((i, -s))[: self.top]
                self.scores[w], self.ids[w] = s[best], i[best]

    def closed(self, threshold: int) -> bool:
        """Whether no row that scores ``threshold`` or less can still enter a window."""
        return all(
            low > high or threshold < low or (len(s) == self.top and threshold < s[-1])
            for (low, high), s in zip(self.bounds, self.scores))


def search(shard: Shard, anchor: np.ndarray, allowed: np.ndarray, windows: Windows) -> int:
    """Run the threshold algorithm over one shard; returns the number of rows scored."""
    n, scored = len(shard.ids), 0
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    if not len(up) and not len(down):
        up = np.zeros(1, np.int64)  # every row scores 0; any list meets them all
    met = ~allowed
    at, step = 0, FIRST
    while at < n:
        stop = min(n, at + step)
        here = np.zeros(n, bool)
        here[shard.order[up, n - stop : n - at]] = True
        here[shard.order[down, at:stop]] = True
        here &= ~met
        met |= here
        rows = np.flatnonzero(here)
        scored += len(rows)
        windows.offer((shard.vectors[rows] @ anchor).astype(np.int64), shard.ids[rows])
        if stop == n:
            break
        last = anchor[up] @ shard.vectors[shard.order[up, n - stop], up] + anchor[down] @ shard.vectors[shard.order[down, stop - 1], down]
        if windows.closed(int(last)):
            break
        at, step = stop, step * 2
    return scored


def write_shards(index: DataFrame, folder: str, width: int) -> DataFrame:
    """Write a file per ``shard`` of (vec_id, label, vec, shard); returns (name, low, high): labels it holds."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["label", "vec_id"])
        name = Shard.build(frame, width).save(folder, int(frame["shard"].iloc[0]) % 1_000_000)
        return pd.DataFrame({"name": [name], "low": [frame["label"].min()], "high": [frame["label"].max()]})

    return index.groupBy("shard").applyInPandas(run, "name string, low bigint, high bigint")


def _listed(manifest: str) -> Iterator[tuple[str, int, int]]:
    store, path = locate(manifest)
    for batch in ds.dataset(path, filesystem=store, format="parquet").to_batches(columns=["name", "low", "high"]):
        yield from zip(*[c.to_pylist() for c in batch.columns])


def mine_negatives(
    vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, shard_rows: int = SHARD,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows where ``is_anchor`` holds. Scores are integer inner products of the vectors
    of ``integer_vectors`` (shorter ones end in zeros); higher come first, ties by smaller id. An
    anchor's positives are its first rows of the same label. For each, the first rows of other
    labels follow whose score is ``least`` to ``most`` per cent of the positive's. Anchors without
    positives, and positives without such rows, give none. Further columns are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    base = scratch.write(integer_vectors(vectors, vec_id, vector, label), "vectors")
    seen = base.agg(
        F.max(F.size("vec")).alias("width"),
        F.max(F.greatest(F.coalesce(F.array_max("vec"), F.lit(0)).cast("bigint"),
                         -F.coalesce(F.array_min("vec"), F.lit(0)).cast("bigint"))).alias("peak")).first()
    width = max(1, seen["width"] or 0)
    # sums of products are exact in doubles below 2^53
    kind = np.float64 if (seen["peak"] or 0) ** 2 * width < 2**53 else np.int64
    order, _ = dense_index(base, "label", "vec_id", name="at")
    folder = f"{scratch.root}/shards"
    scratch.write(
        write_shards(order.select("vec_id", "label", "vec", F.expr(f"at div {shard_rows}").alias("shard")), folder, width), "manifest")
    manifest = f"{scratch.root}/manifest"
    anchors, count = dense_index(base.where(is_anchor), "label", "vec_id", name="nth")
    tasks = task_count(spark)
    size = min(max(-(-count // (4 * tasks)), BLOCK[0]), BLOCK[1])
    blocks = (
        anchors.groupBy(F.expr(f"nth div {size}").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("label", "vec_id", "vec"))).alias("anchors"))  # ``size`` at most
        .repartition(max(1, min(-(-count // size), 4 * tasks)))
    )

    def mine(anchors: list) -> pd.DataFrame:
        matrix = _matrix([a["vec"] for a in anchors], width, kind)
        labels = np.array([a["label"] for a in anchors], np.int64)
        ids = np.array([a["vec_id"] for a in anchors], np.int64)
        near = [Windows([(WHOLE.min, WHOLE.max)], positives) for _ in anchors]
        for name, low, high in _listed(manifest):
            mine = np.flatnonzero((labels >= low) & (labels <= high))
            shard = Shard.load(folder, name, kind) if len(mine) else None
            for k in mine:
                allowed = (shard.labels == labels[k]) & (shard.ids != ids[k])
                if allowed.any():
                    search(shard, matrix[k], allowed, near[k])
        found = [Windows([(-(-least * p // 100), most * p // 100) for p in w.scores[0].tolist()], negatives) for w in near]
        live = np.array([any(low <= high for low, high in w.bounds) for w in found], bool)
        for name, low, high in _listed(manifest):
            mine = np.flatnonzero(live & ~((labels == low) & (labels == high)))
            shard = Shard.load(folder, name, kind) if len(mine) else None
            for k in mine:
                search(shard, matrix[k], shard.labels != labels[k], found[k])
        rows = [
            (ids[k], pid, rank, nid, p, s)
            for k in range(len(anchors))
            for pid, p, scores, negs in zip(near[k].ids[0], near[k].scores[0], found[k].scores, found[k].ids)
            for rank, (s, nid) in enumerate(zip(scores, negs), 1)
        ]
        return pd.DataFrame(rows, columns=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for anchors in frame["anchors"]:
                yield mine(list(anchors))

    return blocks.mapInPandas(
        run, "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
