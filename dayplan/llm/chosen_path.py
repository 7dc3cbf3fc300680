"""Similarity join of n-gram sets by chosen paths.

Texts with the same set of word n-grams form one class. A class is sketched by minhash tokens. A
run starts with all classes in one node and splits every node on sampled sketch places: a class
goes on to the child named by its token there, 1/similarity places a node on average, so a pair
at the wanted similarity stays together in one child on average. Nodes of at most ``leaf``
classes are compared by brute force on sketches; larger ones are split again. The number of runs
follows from the recall that is wanted and from the chance that one run keeps a pair together.

Pairs are never listed. A leaf yields spanning links; their components are then checked exactly,
whole n-gram sets against each other, in blocks: each class learns how many others it is linked
to. Nodes that stay large at the last depth (copies with small edits) count as one component, so
nothing is dropped there; components of any size are checked block against block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.llm.components import components
from dayplan.llm.shared import Scratch, Words, bit_filter, enter, in_filter, mix, pieces

SIZE = 5
SIMILARITY = 0.8
PLACES = 64  # minhash tokens of a sketch
DEPTH = 4
LEAF = 256
RECALL = 0.999
MARGIN = 0.2  # sketches this much below the similarity go to the exact check, 4 standard errors
BLOCK = 400  # classes of a component that one task takes at once, twice
GROUP_TOKENS = 1_500_000  # n-grams that one task takes at once, about


def shingles(words: Words, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every row, sorted within it, and their count per row.

    A row with fewer words, but not none, has one n-gram: all its words.
    """
    n, counts = len(words), words.counts()
    first = np.cumsum(counts) - counts
    with np.errstate(over="ignore"):
        factor = mix(np.arange(size, dtype=np.uint64), 11) | np.uint64(1)
        span = max(0, n - size + 1)
        total = np.zeros(span, np.uint64)
        for k in range(size):
            total += words.hash[k : k + span] * factor[k]
        total = mix(total)
        short = np.flatnonzero((counts > 0) & (counts < size))
        alone = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = counts[short] > k
            alone[has] += words.hash[first[short[has]] + k] * factor[k]
        alone = mix(alone + counts[short].astype(np.uint64), 13)
    sets, sizes = [], np.zeros(words.rows, np.int64)
    lone = dict(zip(short.tolist(), alone))
    for row in np.flatnonzero(counts):
        if row in lone:
            found = np.array([lone[row]], np.uint64)
        else:
            found = np.sort(total[first[row] : first[row] + counts[row] - size + 1])
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        sets.append(found)
        sizes[row] = len(found)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def set_keys(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each row's set; 0 where it is empty."""
    keys = []
    full = np.flatnonzero(sizes)
    start = (np.cumsum(sizes) - sizes)[full]
    with np.errstate(over="ignore"):
        for salt in (21, 22):
            key = np.zeros(len(sizes), np.uint64)
            if len(full):
                key[full] = np.add.reduceat(mix(tokens, salt), start)
            keys.append(key.view(np.int64))
    return keys[0], keys[1]


def sketches(tokens: np.ndarray, sizes: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Upper 32 bits of the least permuted token, per row and place."""
    out = np.zeros((len(sizes), places), np.uint32)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    start = (np.cumsum(sizes) - sizes)[full]
    salt = mix(np.arange(2 * places, dtype=np.uint64), 31)
    with np.errstate(over="ignore"):
        for k in range(places):
            least = np.minimum.reduceat((tokens ^ salt[2 * k]) * (salt[2 * k + 1] | np.uint64(1)), start)
            out[full, k] = (least >> np.uint64(32)).astype(np.uint32)
    return out


def children(nodes: np.ndarray, tokens: np.ndarray, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Row and child node of every step that the rows' nodes sample: 1/similarity places each on average."""
    places = tokens.shape[1]
    where = [(mix(nodes, 41) % np.uint64(places)).astype(np.int64)]
    where.append((where[0] + 1 + (mix(nodes, 42) % np.uint64(places - 1)).astype(np.int64)) % places)
    two = (mix(nodes, 43) >> np.uint64(11)).astype(np.float64) / 2**53 < 1 / similarity - 1
    rows = [np.arange(len(nodes)), np.flatnonzero(two)]
    out = []
    for place, row in zip(where, rows):
        token = tokens[row, place[row]].astype(np.uint64)
        out.append(mix(mix(nodes[row], 44) ^ mix(token + (place[row].astype(np.uint64) << np.uint64(32)), 45)))
    return np.concatenate(rows), np.concatenate(out)


def kept_in_a_run(similarity: float, depth: int) -> float:
    """Chance that a pair at ``similarity`` is still together at ``depth`` of one run."""
    more, stay = 1 / similarity - 1, 1.0
    for _ in range(depth):
        one = similarity * stay
        stay = (1 - more) * one + more * (1 - (1 - one) ** 2)
    return stay


def runs_for(recall: float, similarity: float, depth: int) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - kept_in_a_run(similarity, depth)))


def _leaders(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least vertex of each vertex's component among 0..n-1 under the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, a, low)
        np.minimum.at(fresh, b, low)
        np.minimum.at(fresh, label, fresh)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def _near_pairs(group: np.ndarray, tokens: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the same (sorted) group whose sketches agree in a share ``least`` of places."""
    found_a, found_b = [], []
    size = np.diff(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])))
    left = np.repeat(size, size) - (np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)) - 1
    for step in range(1, int(size.max(initial=1))):
        a = np.flatnonzero(left >= step)
        near = (tokens[a] == tokens[a + step]).sum(1) >= least * tokens.shape[1]
        found_a.append(a[near])
        found_b.append(a[near] + step)
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(found_a or empty), np.concatenate(found_b or empty)


def _matrix(column: pd.Series, places: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, places)


def sketch_rows(docs: DataFrame, doc_id: str, text: str, size: int, places: int) -> DataFrame:
    """(doc_id, key, k1, k2, n, h, sketch) of every row; n = 0 and an empty sketch without words."""
    read = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("copies")
        for whole in batches:
            for batch in pieces(whole, "text"):
                tokens, sizes = shingles(Words(batch.column(1)), size)
                k1, k2 = set_keys(tokens, sizes)
                made = sketches(tokens, sizes, places)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(k1), pa.array(k2), pa.array(sizes),
                     pa.array(row_hash(k1, batch.column(0))),
                     pa.array([made[i].tobytes() if sizes[i] else b"" for i in range(len(sizes))], pa.binary())],
                    names=["doc_id", "key", "k1", "k2", "n", "h", "sketch"])

    return read.mapInArrow(run, "doc_id bigint, key bigint, k1 bigint, k2 bigint, n bigint, h bigint, sketch binary")


def _grow(rows: DataFrame, runs: int | None, similarity: float, places: int) -> DataFrame:
    """Children (id, node) of (id, sketch[, node]); without nodes, of the roots of all runs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enter("copies")
        for frame in batches:
            tokens, ids = _matrix(frame["sketch"], places), frame["id"].to_numpy(np.int64)
            if runs is None:
                starts = [frame["node"].to_numpy(np.int64).view(np.uint64)]
            else:
                starts = [np.full(len(ids), mix(np.array([r], np.uint64), 51)[0]) for r in range(runs)]
            for nodes in starts:
                row, node = children(nodes, tokens, similarity)
                yield pd.DataFrame({"id": ids[row], "node": node.view(np.int64)})

    return rows.mapInPandas(run, "id bigint, node bigint")


def candidate_links(
    classes: DataFrame, scratch: Scratch, similarity: float, recall: float, depth: int, leaf: int, places: int,
) -> DataFrame:
    """Spanning links (a, b) among the classes (id, sketch) that share a leaf and have near sketches."""
    runs = runs_for(recall, similarity, depth)
    nodes, links, leaves = _grow(classes, runs, similarity, places), [], []
    for level in range(1, depth + 1):
        nodes = scratch.write(nodes, f"nodes-{level}")
        sizes = nodes.groupBy(F.col("node").alias("_node")).agg(F.count("*").alias("size"), F.min("id").alias("least"))
        shared = scratch.write(
            nodes.join(sizes.where("size > 1"), F.col("node") == F.col("_node")).drop("_node"), f"shared-{level}")
        leaves.append(shared.where(F.col("size") <= leaf).select("id", "node"))
        large = shared.where(F.col("size") > leaf)
        if level == depth:
            links.append(large.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")))
        elif large.isEmpty():
            break
        else:
            nodes = _grow(large.select("id", "node").join(classes, "id"), None, similarity, places)
    rows = leaves[0]
    for more in leaves[1:]:
        rows = rows.unionAll(more)
    count = rows.count()
    groups = max(1, -(-count // 20_000))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        enter("copies")
        frame = frame.sort_values(["node", "id"], ignore_index=True)
        ids = frame["id"].to_numpy(np.int64)
        a, b = _near_pairs(frame["node"].to_numpy(np.int64), _matrix(frame["sketch"], places), similarity - MARGIN)
        label = _leaders(len(frame), a, b)
        own = label != np.arange(len(label))
        return pd.DataFrame({"a": ids[own], "b": ids[label[own]]}).drop_duplicates()

    brute = (
        rows.join(classes, "id").withColumn("g", F.pmod(F.xxhash64("node"), F.lit(groups)))
        .groupBy("g").applyInPandas(compare, "a bigint, b bigint")
    )
    for more in links:
        brute = brute.unionAll(more)
    return brute


def _fetch_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """Rows of ``wanted`` (id, k1, k2, least_doc, h, ...) with the set of n-grams in ``tokens``, once each.

    Texts are read again; a bit filter of fixed size lets through the chosen row of each class and
    few others, so only the sets of classes that may be linked are ever shuffled.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted.select("h")))
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("copies")
        for whole in batches:
            for batch in pieces(whole, "text"):
                tokens, sizes = shingles(Words(batch.column(1)), size)
                k1, k2 = set_keys(tokens, sizes)
                keep = np.flatnonzero(in_filter(bits.value, row_hash(k1, batch.column(0))) & (sizes > 0))
                begin = np.cumsum(sizes) - sizes
                sets = [tokens[begin[i] : begin[i] + sizes[i]].view(np.int64) for i in keep]
                ends = np.concatenate([[0], np.cumsum(sizes[keep])]).astype(np.int32)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keep)), pa.array(k1[keep]), pa.array(k2[keep]),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["d", "c1", "c2", "tokens"])

    sets = read.mapInArrow(run, "d bigint, c1 bigint, c2 bigint, tokens array<bigint>")
    return sets.join(
        wanted, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")) & F.col("d").eqNullSafe(F.col("least_doc"))
    ).drop("d", "c1", "c2", "k1", "k2", "least_doc", "h").dropDuplicates(["id"])


def row_hash(k1: np.ndarray, doc_id: pa.Array) -> np.ndarray:
    known = doc_id.is_valid().to_numpy(zero_copy_only=False)
    number = doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    with np.errstate(over="ignore"):
        return mix(k1.view(np.uint64) + mix(number.view(np.uint64), 61) + known.astype(np.uint64), 62).view(np.int64)


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], cells: int = 4_000_000) -> np.ndarray:
    """Sizes of all intersections of the sets ``a`` with the sets ``b``, by products of incidence matrices."""
    sizes = np.array([len(x) for x in [*a, *b]])
    member = np.repeat(np.arange(len(sizes)), sizes)
    tokens, number, times = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    # a token matters if a set on either side has it
    left = np.bincount(number[member < len(a)], minlength=len(tokens)) > 0
    right = np.bincount(number[member >= len(a)], minlength=len(tokens)) > 0
    shared = left & right
    column = np.cumsum(shared) - 1
    use = shared[number]
    member, place = member[use], column[number[use]]
    order = np.argsort(place, kind="stable")
    member, place = member[order], place[order]
    out = np.zeros((len(a), len(b)), np.float32)
    step = max(1, cells // len(sizes))
    for start in range(0, int(shared.sum()), step):
        lo, hi = np.searchsorted(place, [start, start + step])
        inside = np.zeros((len(sizes), step), np.float32)
        inside[member[lo:hi], place[lo:hi] - start] = 1
        out += inside[: len(a)] @ inside[len(a) :].T
    return out


def check_unit(ids, copies, sets, side, similarity) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of the classes of one unit: (texts, documents, leader) per class.

    ``side`` is 0 or 1 for two blocks to be held against each other, 2 for one block against itself.
    """
    n = len(ids)
    order = np.argsort(ids)
    texts, documents, leader = np.zeros(n, np.int64), np.zeros(n, np.int64), ids.copy()
    a, b = (order, order) if side[0] == 2 else (order[side[order] == 0], order[side[order] == 1])
    if not len(a) or not len(b) or n < 2:
        return texts, documents, leader
    size = np.array([len(x) for x in sets], np.float64)
    both = _overlaps([sets[i] for i in a], [sets[i] for i in b]).astype(np.float64)
    linked = both / (size[a][:, None] + size[b][None, :] - both) >= similarity
    if side[0] == 2:
        np.fill_diagonal(linked, False)
    texts[a] += linked.sum(1)
    documents[a] += linked @ copies[b]
    if side[0] != 2:
        texts[b] += linked.sum(0)
        documents[b] += copies[a] @ linked
    x, y = np.nonzero(linked)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    leader = ids[order][_leaders(n, rank[a[x]], rank[b[y]])[rank]]
    return texts, documents, leader


def exact_links(members: DataFrame, similarity: float, scratch: Scratch, tokens: int) -> DataFrame:
    """(id, texts, documents, leader, whole) per class and unit of the components' exact check.

    ``members``: id, root, size (of the component), copies, n, tokens. A component of at most BLOCK
    classes is one unit, and its leaders are final (``whole``); a larger one is cut into blocks,
    a unit for every two of them.
    """
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    unit = members.withColumn("blocks", blocks).withColumn("block", own.cast("int"))
    unit = unit.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "copies", "tokens", (F.col("blocks") == 1).alias("whole"),
        F.when(F.col("other") == F.col("block"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
        F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
    )
    groups = max(1, -(-tokens // GROUP_TOKENS))

    def check(frame: pd.DataFrame) -> pd.DataFrame:
        enter("copies")
        out = []
        for _, part in frame.groupby("unit", sort=False):
            ids = part["id"].to_numpy(np.int64)
            texts, documents, leader = check_unit(
                ids, part["copies"].to_numpy(np.int64), part["tokens"].tolist(), part["side"].to_numpy(), similarity)
            out.append(pd.DataFrame({
                "id": ids, "texts": texts, "documents": documents, "leader": leader, "whole": part["whole"].to_numpy()}))
        return pd.concat(out)

    units = unit.withColumn("g", F.pmod(F.xxhash64("unit"), F.lit(groups))).groupBy("g").applyInPandas(
        check, "id bigint, texts bigint, documents bigint, leader bigint, whole boolean")
    return scratch.write(units, "units")


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, similarity: float = SIMILARITY,
    recall: float = RECALL, depth: int = DEPTH, leaf: int = LEAF, places: int = PLACES,
) -> DataFrame:
    """(doc_id, class_id, n_links, n_text_links, class_key, key) of every row of ``docs``.

    Two documents are linked if the Jaccard similarity of their sets of n-grams is at least
    ``similarity``; a class is a connected group, named by its least doc_id. ``n_links`` counts the
    other documents linked to one, copies too; ``n_text_links`` counts the different texts.
    ``class_key`` tells classes apart even where ids repeat or are null, ``key`` is xxhash64 of the
    text. Documents without words have no link and are their own class (null if doc_id is; their
    class_key is null). Repeated rows count as copies. Links found are exact; one is lost with a chance below
    1 - ``recall`` for a pair at ``similarity`` that no third text ties together.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "chosen-path")
    rows = scratch.write(sketch_rows(docs, doc_id, text, size, places), "rows")
    named = rows.where("n > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("least_doc"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"), F.coalesce(F.min_by("h", "doc_id"), F.min("h")).alias("h"))
    classes = scratch.write(named.withColumn("id", F.monotonically_increasing_id()), "classes")
    links = candidate_links(classes.select("id", "sketch"), scratch, similarity, recall, depth, leaf, places)
    roots = components(links, scratch)
    sizes = roots.groupBy("root").agg((F.count("*") + 1).alias("size"))
    inside = roots.unionAll(roots.select(F.col("root").alias("id"), "root").distinct()).join(sizes, "root")
    wanted = scratch.write(classes.drop("sketch").join(inside, "id"), "wanted")
    tokens = wanted.agg(F.sum(F.col("n") * F.ceil(F.col("size") / F.lit(BLOCK)))).first()[0] or 0
    units = exact_links(_fetch_sets(docs, wanted, doc_id, text, size), similarity, scratch, int(tokens))
    counts = units.groupBy("id").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    parted = units.where(~F.col("whole") & (F.col("id") != F.col("leader"))).select(
        F.col("id").alias("a"), F.col("leader").alias("b"))
    leaders = units.where("whole and id <> leader").select("id", F.col("leader").alias("root"))
    if not parted.isEmpty():
        leaders = leaders.unionAll(components(parted, Scratch(spark, "chosen-path")))
    final = scratch.write(
        classes.select("id", "k1", "k2", "least_doc", "copies")
        .join(leaders, "id", "left").join(counts, "id", "left")
        .withColumn("root", F.coalesce("root", "id")), "final")
    names = final.groupBy(F.col("root").alias("r")).agg(F.min("least_doc").alias("class_id"))
    known = final.join(names, F.col("root") == F.col("r")).select(
        F.col("k1").alias("c1"), F.col("k2").alias("c2"), "class_id", F.col("root").alias("class_key"),
        (F.coalesce("documents", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("texts", F.lit(0)).alias("texts"))
    found = rows.select("doc_id", "key", "k1", "k2", "n").join(
        known, (F.col("n") > 0) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left")
    return found.select(
        "doc_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"),
        "class_key", "key")


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The row with the least id of each class of ``docs``, with its columns as they are.

    Ties go to the least hash of the text, a null id comes last, and of rows that agree in both one
    stays. Rows without words are all kept. What goes is named by id and hash and taken away by an
    anti join; the planner broadcasts the names only when their stored size is small.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "keep-one")
    found = scratch.write(similar_documents(docs, doc_id, text, **settings).where("class_key is not null"), "classes")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")
    best = found.groupBy(F.col("class_key").alias("c")).agg(F.min(place).alias("best"))
    judged = found.groupBy("class_key", "doc_id", "key").agg(F.count("*").alias("n")).join(
        best, F.col("class_key") == F.col("c")).select("doc_id", "key", "n", (place == F.col("best")).alias("stays"))
    judged = scratch.write(judged, "judged")
    row = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("bigint").alias("d"), F.xxhash64(F.col(text)).alias("h"))
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("key"))
    kept = row.join(judged.where("not stays").select("doc_id", "key"), same, "left_anti")
    twice = judged.where("stays and n > 1").select("doc_id", "key")
    if not twice.isEmpty():
        kept = kept.join(twice, same, "left_anti").unionAll(
            kept.join(twice, same, "left_semi").dropDuplicates(["d", "h"]))
    return kept.select("row.*")
