"""Nearest neighbours by multiprobe p-stable hashing.

Unit vectors are projected on Gaussian directions and cut into cells of a fixed width; the cells
of several directions name a bucket, once per table. A query visits, in each table, its own
bucket and the perturbed ones in order of estimated success: the sum of squared distances from
its projections to the cell borders that a perturbation crosses. All candidates of a visited
bucket are scored exactly, the best of every bucket group are merged over tables and ranked.

Hashes follow the number of rows, one more for every doubling, so buckets do not fill up; a further
hash asks for ``GROWTH`` times the visits at equal recall. Buckets halve where visits grow by less
than two, so the share of rows that a query sees falls as the table grows.

Bucket rows are dealt out in groups of bounded size; a bucket above the bound is cut into parts
that are visited one by one, so nothing is dropped. Queries that find too few rows are held
against all rows, in blocks. No vector set is collected or broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayplan.llm.shared import Scratch, bit_filter, in_filter, mix

TABLES = 3
HASHES = 8  # at least, see ``sizes``
WIDTH = 2.4
PROBES = 300  # buckets visited per table with HASHES hashes
GROWTH = 1.6  # times the visits for every further hash
ROWS_PER_BUCKET = 64  # rows over 2 ** hashes
PROBE_CELLS = 1 << 17  # perturbations that a task holds at once
GROUP_ROWS = 20_000  # bucket rows that one task takes at once, about
_SEED = 20_240_131


@lru_cache(maxsize=8)
def _directions(dim: int, table: int, hashes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([_SEED, dim, table])
    return rng.normal(size=(dim, hashes)), rng.random(hashes) * width


def sizes(rows: int) -> tuple[int, int]:
    """(hashes, visits per table) for a table of ``rows`` rows."""
    hashes = max(HASHES, round(math.log2(max(rows, 1) / ROWS_PER_BUCKET)))
    return hashes, math.ceil(PROBES * GROWTH ** (hashes - HASHES))


def _moves(off: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` cheapest perturbations (rows, probes, hashes) of -1, 0 and 1, cheapest first.

    ``off`` says how far into its cell each projection lies. A cheapest perturbation of some hashes
    extends one of the cheapest of the hashes before, so a hash at a time is added and the rest let go.
    """
    steps = np.array([0, -1, 1], np.int8)
    cost = np.zeros((len(off), 1))
    moves = np.zeros((len(off), 1, 0), np.int8)
    for k in range(off.shape[1]):
        o = off[:, k, None]
        longer = np.stack([cost, cost + o**2, cost + (1 - o) ** 2], axis=2).reshape(len(off), -1)
        kept = np.broadcast_to(np.arange(longer.shape[1]), longer.shape)
        if longer.shape[1] > probes:
            kept = np.argpartition(longer, probes - 1, axis=1)[:, :probes]
        cost = np.take_along_axis(longer, kept, 1)
        moves = np.concatenate([np.take_along_axis(moves, (kept // 3)[:, :, None], 1), steps[kept % 3][:, :, None]], axis=2)
    return np.take_along_axis(moves, np.argsort(cost, axis=1, kind="stable")[:, :, None], 1)


def _key(cells: np.ndarray, table: int, dim: int) -> np.ndarray:
    """Bucket key over the last axis of ``cells``."""
    key = np.full(cells.shape[:-1], mix(np.array([table * 65_537 + dim], np.uint64), 71)[0])
    for k in range(cells.shape[-1]):
        key = mix(key ^ cells[..., k].astype(np.int64).view(np.uint64), 72)
    return key.view(np.int64)


def bucket_keys(unit: np.ndarray, tables: int, hashes: int, width: float) -> list[np.ndarray]:
    out = []
    for table in range(tables):
        a, b = _directions(unit.shape[1], table, hashes, width)
        out.append(_key(np.floor((unit @ a + b) / width), table, unit.shape[1]))
    return out


def probe_keys(unit: np.ndarray, tables: int, hashes: int, width: float, probes: int) -> list[np.ndarray]:
    """Keys to visit per table, (rows, probes), best first."""
    out = []
    for table in range(tables):
        a, b = _directions(unit.shape[1], table, hashes, width)
        place = (unit @ a + b) / width
        cell = np.floor(place)
        out.append(_key(cell[:, None, :] + _moves(place - cell, probes), table, unit.shape[1]))
    return out


def _group(key: np.ndarray, groups: int) -> np.ndarray:
    return (mix(key.view(np.uint64), 73) % np.uint64(groups)).astype(np.int64)


def _visits(asked: pd.DataFrame, keys: list[np.ndarray], heavy: list[np.ndarray], groups: int) -> pd.DataFrame:
    """A row per query and group with the keys to visit there, and a row per key that may be of a cut bucket."""
    out: list[tuple] = []
    for vec_id, vec, key, cut in zip(asked["vec_id"], asked["vec"], keys, heavy):
        out += [(vec_id, vec, _group(k, groups)[0], k, True) for k in key[cut][:, None]]
        key = key[~cut]
        group = _group(key, groups)
        order = np.argsort(group, kind="stable")
        key, group = key[order], group[order]
        edges = np.flatnonzero(np.diff(group)) + 1
        out += [(vec_id, vec, _group(k[:1], groups)[0], k, False) for k in np.split(key, edges) if len(k)]
    return pd.DataFrame(out, columns=["id", "vec", "g", "keys", "heavy"])


def _unit(vectors: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) per dimension."""
    sizes = vectors.map(len).to_numpy()
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        found = np.stack(vectors.iloc[rows].tolist()).astype(np.float64)
        found /= np.abs(found).max(1, keepdims=True)
        yield rows, found / np.sqrt((found * found).sum(1, keepdims=True))


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vec, dim) of rows with an id and a vector that is not null, empty or zero and has finite parts.

    A repeated id counts once, with its least vector.
    """
    v = F.col(vector).cast("array<double>")
    sound = (F.size(v) > 0) & F.coalesce(F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)), F.lit(False))
    return (
        vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("vec"), sound.alias("ok"))
        .where("vec_id is not null and ok").where(F.exists("vec", lambda x: x != 0))
        .groupBy("vec_id").agg(F.min("vec").alias("vec"))
        .withColumn("dim", F.size("vec"))
    )


def _level(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1: the same cosines, no overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _norm(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def _search(frame: pd.DataFrame, top: int) -> pd.DataFrame:
    """Best rows of each query of a group: columns kind (0 row, 1 query), id, vec, keys."""
    queries = frame[frame["kind"] == 1].reset_index(drop=True)
    rows = frame[frame["kind"] == 0].reset_index(drop=True)
    empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    if not len(queries) or not len(rows):
        return empty
    key = np.array([k[0] for k in rows["keys"]], np.int64)
    order = np.lexsort((rows["id"].to_numpy(), key))
    rows, key = rows.iloc[order].reset_index(drop=True), key[order]
    times = queries["keys"].map(len).to_numpy()
    asked = np.concatenate(queries["keys"].tolist()).astype(np.int64)
    who = np.repeat(np.arange(len(queries)), times)
    sort = np.argsort(asked, kind="stable")
    asked, who = asked[sort], who[sort]
    ids, query_ids = rows["id"].to_numpy(np.int64), queries["id"].to_numpy(np.int64)
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    for low, high in zip(edges[:-1], edges[1:]):
        a, b = np.searchsorted(asked, key[low], "left"), np.searchsorted(asked, key[low], "right")
        if a == b:
            continue
        cands = _level(np.stack(rows["vec"].iloc[low:high].tolist()))
        c_norm = _norm(cands)
        step = max(1, 100_000 // (high - low))
        for at in range(a, b, step):
            q = who[at : min(at + step, b)]
            wanted = _level(np.stack(queries["vec"].iloc[q].tolist()))
            q_norm = _norm(wanted)
            rough = (wanted @ cands.T) / q_norm[:, None] / c_norm[None, :]
            rough[query_ids[q][:, None] == ids[low:high][None, :]] = -np.inf
            k = min(top, rough.shape[1])
            least = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k]
            i, j = np.nonzero((rough >= least[:, None] - 1e-9) & (rough > -np.inf))
            score = (wanted[i] * cands[j]).sum(1) / (q_norm[i] * c_norm[j])
            pairs.append(_best(q[i], ids[low + j], score, top))
    q, v, s = (np.concatenate(x) for x in zip(*pairs))
    q, v, s = _best(q, v, s, top)
    return pd.DataFrame({"query_id": query_ids[q], "vec_id": v, "score": s})


def _best(q: np.ndarray, v: np.ndarray, s: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``top`` different rows of each query by score, then id."""
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])
    q, v, s = q[fresh], v[fresh], s[fresh]
    nth = np.arange(len(q)) - np.searchsorted(q, q, "left")
    return q[nth < top], v[nth < top], s[nth < top]


def _searched(rows: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """Search groups ``g`` of rows (id, vec, key) by queries (id, vec, keys)."""
    both = rows.select("g", F.lit(0).alias("kind"), "id", "vec", F.array("key").alias("keys")).unionAll(
        queries.select("g", F.lit(1).alias("kind"), "id", "vec", "keys"))
    return both.groupBy("g").applyInPandas(
        lambda frame: _search(frame, top), "query_id bigint, vec_id bigint, score double")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", place).where(
        F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", top: int = 5,
    tables: int = TABLES, hashes: int | None = None, width: float = WIDTH, probes: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` found rows of largest cosine, ties to the smaller id.

    Queries are the rows where ``is_query`` holds; a row is not its own neighbour. Vectors of other
    length never meet. Unusable vectors take no part, see ``usable``. A query for which the buckets
    hold fewer than ``top`` rows is answered by an exact search over all rows. Hashes and probes
    (buckets visited per table) follow the number of rows where they are not given.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    base, count = scratch.write_counting(usable(vectors, vec_id, vector), "vectors")
    asking = base.where(is_query)
    own_hashes, own_probes = sizes(count)
    hashes, probes = hashes or own_hashes, probes or own_probes
    at_once = max(1, PROBE_CELLS // probes)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    groups = max(1, -(-count * tables // GROUP_ROWS))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for rows, unit in _unit(frame["vec"]):
                for key in bucket_keys(unit, tables, hashes, width):
                    yield pd.DataFrame({"id": frame["vec_id"].to_numpy()[rows], "g": _group(key, groups), "key": key})

    places = scratch.write(base.select("vec_id", "vec").mapInPandas(place, "id bigint, g bigint, key bigint"), "places")
    bits = spark.sparkContext.broadcast(bit_filter(places.select("key")))
    large = scratch.write(
        places.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_ROWS).select(
            F.col("key").alias("big"), F.ceil(F.col("n") / F.lit(GROUP_ROWS)).alias("parts")), "large")
    heavy = spark.sparkContext.broadcast(bit_filter(large.select(F.col("big").alias("key"))))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for at in range(0, len(frame), at_once):
                part = frame.iloc[at : at + at_once]
                for rows, unit in _unit(part["vec"]):
                    asked = part.iloc[rows]
                    every = np.concatenate(probe_keys(unit, tables, hashes, width, probes), axis=1)
                    keys = [k[in_filter(bits.value, k)] for k in every]
                    yield _visits(asked, keys, [in_filter(heavy.value, k) for k in keys], groups)

    visits = asking.select("vec_id", "vec").repartition(n).mapInPandas(
        probe, "id bigint, vec array<double>, g bigint, keys array<bigint>, heavy boolean")
    visits = scratch.write(visits, "visits")
    parts = F.coalesce("parts", F.lit(1))
    part_key = F.when(F.col("big").isNull(), F.col("key")).otherwise(F.xxhash64("key", "part"))
    part_group = F.when(F.col("big").isNull(), F.col("g")).otherwise(F.pmod(F.xxhash64("key", "part"), F.lit(groups)))
    rows = (
        places.join(large, F.col("key") == F.col("big"), "left").withColumn("part", F.pmod(F.xxhash64("id"), parts))
        .select("id", part_group.alias("g"), part_key.alias("key"))
        .join(base.select(F.col("vec_id").alias("id"), "vec"), "id")
    )
    in_parts = (
        visits.where("heavy").withColumn("key", F.col("keys")[0]).join(large, F.col("key") == F.col("big"), "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
        .select("id", "vec", part_group.alias("g"), F.array(part_key).alias("keys"))
    )
    wanted = visits.where("not heavy").select("id", "vec", "g", "keys").unionAll(in_parts)
    found = scratch.write(_ranked(_searched(rows, wanted, top), top), "found")
    reach = base.groupBy("dim").agg(F.least(F.count("*") - 1, F.lit(top)).alias("most"))
    got = found.groupBy("query_id").agg(F.count("*").alias("got"))
    short = scratch.write(
        asking.join(reach, "dim").join(got, F.col("vec_id") == F.col("query_id"), "left")
        .where(F.coalesce("got", F.lit(0)) < F.col("most")).select(F.col("vec_id").alias("id"), "vec", "dim"), "short")
    if short.isEmpty():
        return found
    blocks = max(1, -(-count // GROUP_ROWS))
    everything = base.select(F.col("vec_id").alias("id"), "vec", F.col("dim").cast("bigint").alias("key")).withColumn(
        "g", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    exact = _searched(
        everything, short.select("id", "vec", F.array(F.col("dim").cast("bigint")).alias("keys"))
        .withColumn("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))), top)
    rest = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
    return rest.unionAll(_ranked(exact, top).select(*rest.columns))
