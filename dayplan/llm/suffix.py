"""Benchmark decontamination by suffix arrays of the training text.

Every piece of training text is a shard. Its suffixes are sorted by prefix doubling up to the
length of the longest test text, and all suffixes of all test texts are binary-searched in it at
once. That gives each test suffix's longest verbatim match and every place where a window of it
occurs. A suffix that holds a word no test text has within its first words cannot match, so only
runs of known words that are long enough enter the array.

Equal test suffixes are searched once, and equal windows mark their places once, so repeats on both
sides never multiply.

Documents never move: a shard is what a task has read. Test texts lie in the shared folder in
blocks of bounded size; a task holds a few at a time.

Words are runs of digits, letters (A-Z lower-cased) and non-ASCII characters; words are compared
by 64-bit hashes. A null or wordless text has no words: as a document it is clean, as a test text
it has no window. A test text shorter than a window is one window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.llm.files import locate
from dayplan.llm.shared import Scratch, Words, ddl, pieces, struct_fields

WINDOW = 10
BLOCK_BYTES = 4 << 20  # text bytes of a block of test texts
HELD_BLOCKS = 4  # blocks that a worker keeps; more are read again for every shard
SHARD_BYTES = 4 << 20  # text bytes of a shard


@dataclass
class TestBlock:
    """Test texts as word numbers, and their different suffixes in order."""

    items: list[str]
    vocabulary: np.ndarray  # sorted word hashes
    tokens: np.ndarray  # word numbers of all items, -1 behind each
    start: np.ndarray  # a place of every different suffix, in order of their words
    left: np.ndarray  # words from there to the item's end
    least: np.ndarray  # the least item that has the suffix
    suffix: np.ndarray  # different windows: the number of the suffix that starts with it,
    size: np.ndarray  # its words,
    having: list[np.ndarray]  # and the items it stands for there

    @property
    def shortest(self) -> int:
        return int(self.size.min()) if len(self.size) else 0


def encode_tests(items: list[str], texts: pa.Array, window: int = WINDOW) -> TestBlock:
    words = Words(texts)
    vocabulary, number = np.unique(words.hash, return_inverse=True)
    counts = words.counts()
    place = np.arange(len(words)) + words.row  # one -1 behind each item
    tokens = np.full(len(words) + len(items), -1, np.int64)
    tokens[place] = number
    row = np.full(len(tokens), -1, np.int64)
    row[place] = words.row
    first = np.cumsum(counts) - counts
    left = np.zeros(len(tokens), np.int64)
    left[place] = counts[words.row] - (np.arange(len(words)) - first[words.row])
    order = suffix_order(tokens, int(left.max(initial=0)) + 1)
    same = np.zeros(len(order), bool)
    if len(order) > 1:
        equal = np.flatnonzero(left[order[1:]] == left[order[:-1]])
        _, agree = _compare(tokens, order[equal], tokens, order[equal + 1], left[order[equal]])
        same[equal + 1] = agree == left[order[equal]]
    group = np.cumsum(~same) - 1
    head = order[~same]
    # items in order of their ids as text, so the least of a suffix is its least item
    rank = np.argsort(np.argsort(np.array(items, object), kind="stable")) if items else np.zeros(0, np.int64)
    best = np.full(len(head), len(items), np.int64)
    np.minimum.at(best, group, rank[row[order]])
    item_of = np.argsort(rank)
    size = np.minimum(window, counts)[row[order]]
    fits = np.flatnonzero(left[order] >= size)
    key = np.unique(np.stack([group[fits], size[fits], row[order][fits]], 1), axis=0)
    edge = np.flatnonzero(np.concatenate([[True], (key[1:, :2] != key[:-1, :2]).any(1), [True]])) if len(key) else np.zeros(1, np.int64)
    return TestBlock(
        items, vocabulary, tokens, head, left[head], item_of[best] if len(head) else best,
        key[edge[:-1], 0], key[edge[:-1], 1], [key[i:j, 2] for i, j in zip(edge[:-1], edge[1:])])


def suffix_order(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``tokens`` that are not -1, sorted by the ``depth`` tokens from there (-1 is least).

    What follows a -1 does not matter: places that agree up to one are in any order.
    """
    n, inside = len(tokens), int((tokens >= 0).sum())
    rank = tokens + 1
    known = 1
    order = np.argsort(rank, kind="stable")
    while known < depth:
        shifted = np.zeros(n, np.int64)
        shifted[: max(0, n - known)] = rank[known:]
        shifted[rank == 0] = 0
        key = rank * (int(rank.max(initial=0)) + 1) + shifted
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        rank, known = fresh, known * 2  # rank 0 stays with -1, which stands behind every run
        if fresh[order[-1]] == inside:
            break
    return order[tokens[order] >= 0]


def _compare(tokens, places, tests, starts, length) -> tuple[np.ndarray, np.ndarray]:
    """Sign of suffix against test over ``length`` words, and how many words agree."""
    sign = np.zeros(len(places), np.int8)
    agree = np.zeros(len(places), np.int64)
    live = np.arange(len(places))
    depth = 0
    while len(live):
        live = live[length[live] > depth]
        a = tokens[np.minimum(places[live] + depth, len(tokens) - 1)]
        b = tests[starts[live] + depth]
        same = a == b
        sign[live[~same]] = np.where(a[~same] < b[~same], -1, 1)
        live = live[same]
        agree[live] += 1
        depth += 1
    return sign, agree


def _bound(tokens, order, tests, starts, length, upper: bool) -> np.ndarray:
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(order), np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        sign, _ = _compare(tokens, order[middle], tests, starts[live], length[live])
        up = sign <= 0 if upper else sign < 0
        low[live[up]] = middle[up] + 1
        high[live[~up]] = middle[~up]


@dataclass
class Hits:
    hit: np.ndarray  # per word of the shard
    items: list[set[str]]  # per row
    longest: np.ndarray  # per row
    matches: list[list[tuple[int, int, str]]]  # per row: first word, words, item


def search(words: Words, block: TestBlock, out: Hits) -> None:
    """Search all suffixes of ``block`` in the shard ``words`` and add to ``out``."""
    if not len(block.start) or not len(words):
        return
    at = np.minimum(np.searchsorted(block.vocabulary, words.hash), len(block.vocabulary) - 1)
    known = block.vocabulary[at] == words.hash
    # runs of known words within a row that can hold a window
    edge = np.ones(len(words), bool)
    edge[1:] = (words.row[1:] != words.row[:-1]) | ~known[1:] | ~known[:-1]
    run = np.cumsum(edge) - 1
    size = np.bincount(run)
    keep = np.flatnonzero(known & (size[run] >= block.shortest))
    if not len(keep):
        return
    gap = np.concatenate([[0], np.cumsum(run[keep][1:] != run[keep][:-1])])
    place = np.arange(len(keep)) + gap
    tokens = np.full(len(keep) + int(gap[-1]) + 1, -1, np.int64)
    tokens[place] = at[keep]
    word = np.full(len(tokens), -1, np.int64)
    word[place] = keep
    order = suffix_order(tokens, int(block.left.max()))
    # the longest match of a suffix is with one of its two neighbours
    near = _bound(tokens, order, block.tokens, block.start, block.left, upper=False)
    longest = _agreement(tokens, order, block, near)
    fits = np.flatnonzero(longest[block.suffix] >= block.size)
    if not len(fits):
        return
    start, size = block.start[block.suffix[fits]], block.size[fits]
    low = _bound(tokens, order, block.tokens, start, size, upper=False)
    high = _bound(tokens, order, block.tokens, start, size, upper=True)
    # equal windows stand for the same places: every place is looked at once for each window size
    ranges, which = np.unique(np.stack([low, high, size], 1), axis=0, return_inverse=True)
    which = which.ravel()
    sets: dict[bytes, int] = {}
    having = []
    set_of = np.zeros(len(ranges), np.int64)
    by = np.argsort(which, kind="stable")
    for r, members in enumerate(np.split(fits[by], np.flatnonzero(np.diff(which[by])) + 1)):
        items = np.unique(np.concatenate([block.having[k] for k in members]))
        if items.tobytes() not in sets:
            sets[items.tobytes()] = len(having)
            having.append([block.items[i] for i in items])
        set_of[r] = sets[items.tobytes()]
    many = ranges[:, 1] - ranges[:, 0]
    r = np.repeat(np.arange(len(ranges)), many)
    spot = order[np.arange(len(r)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(ranges[:, 0], many)]
    first, size = word[spot], ranges[r, 2]
    delta = np.zeros(len(words) + 1, np.int64)
    np.add.at(delta, first, 1)
    np.add.at(delta, first + size, -1)
    out.hit |= np.cumsum(delta[:-1]) > 0
    for pair in np.unique(words.row[first] * len(having) + set_of[r]):
        out.items[pair // len(having)].update(having[pair % len(having)])
    # per place the longest window, and the longest match if that is at least as long as any window
    by = np.lexsort((size, spot))
    last = np.flatnonzero(np.append(spot[by][1:] != spot[by][:-1], True))
    spot, size, r = spot[by][last], size[by][last], r[by][last]
    words_, item = _longest_from(tokens, spot, block)
    window = int(block.size.max())
    short = words_ < window
    words_[short] = size[short]
    first = word[spot]
    row = words.row[first]
    np.maximum.at(out.longest, row, words_)
    # a match is reported where the one before does not hold it
    inside = np.zeros(len(spot), bool)
    inside[1:] = (spot[1:] == spot[:-1] + 1) & (words_[:-1] > words_[1:])
    begin = np.searchsorted(words.row, np.arange(words.rows))
    for i in np.flatnonzero(~inside):
        name = having[set_of[r[i]]][0] if short[i] else block.items[item[i]]
        out.matches[row[i]].append((int(first[i] - begin[row[i]]), int(words_[i]), name))


def _agreement(tokens: np.ndarray, order: np.ndarray, block: TestBlock, near: np.ndarray) -> np.ndarray:
    """Words that each test suffix shares with the closer of its neighbours in the shard's suffix array."""
    longest = np.zeros(len(near), np.int64)
    for step in (-1, 0):
        there = (near + step >= 0) & (near + step < len(order))
        _, agree = _compare(tokens, order[near[there] + step], block.tokens, block.start[there], block.left[there])
        longest[there] = np.maximum(longest[there], agree)
    return longest


def _longest_from(tokens: np.ndarray, spot: np.ndarray, block: TestBlock) -> tuple[np.ndarray, np.ndarray]:
    """Words of the longest match that starts at each place, and the item it is in."""
    low, high = np.zeros(len(spot), np.int64), np.full(len(spot), len(block.start), np.int64)
    while len(live := np.flatnonzero(low < high)):
        middle = (low[live] + high[live]) // 2
        sign, _ = _compare(tokens, spot[live], block.tokens, block.start[middle], block.left[middle])
        up = sign >= 0  # a suffix that the place starts with stands before it
        low[live[up]] = middle[up] + 1
        high[live[~up]] = middle[~up]
    best, item = np.zeros(len(spot), np.int64), np.zeros(len(spot), np.int64)
    for step in (-1, 0):
        there = np.flatnonzero((low + step >= 0) & (low + step < len(block.start)))
        at = low[there] + step
        _, agree = _compare(tokens, spot[there], block.tokens, block.start[at], block.left[at])
        more = agree > best[there]
        best[there[more]], item[there[more]] = agree[more], block.least[at[more]]
    return best, item


@lru_cache(maxsize=HELD_BLOCKS)
def _load(path: str, block: int, window: int) -> TestBlock:
    store, root = locate(path)
    found = pq.read_table(f"{root}/block={block}", filesystem=store, columns=["item", "text"], partitioning=None)
    found = found.combine_chunks()
    text = found["text"].combine_chunks() if found.num_rows else pa.array([], pa.string())
    return encode_tests(found["item"].to_pylist(), text, window)


def scan(batch: pa.RecordBatch, text: str, path: str, blocks: list[int], window: int) -> tuple[Words, Hits]:
    words = Words(batch.column(batch.schema.get_field_index(text)))
    n = batch.num_rows
    out = Hits(np.zeros(len(words), bool), [set() for _ in range(n)], np.zeros(n, np.int64), [[] for _ in range(n)])
    for block in blocks:
        search(words, _load(path, block, window), out)
    return words, out


def store_tests(bench: DataFrame, item_id: str, text: str, block_bytes: int = BLOCK_BYTES) -> tuple[str, list[int]]:
    """Write test texts to the shared folder in blocks; returns the path and the block numbers."""
    scratch = Scratch(bench.sparkSession, "tests")
    total = bench.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    kept = bench.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(item_id, text), F.lit(blocks)).cast("int").alias("block"),
    )
    path = f"{scratch.root}/tests"
    kept.repartition("block").write.partitionBy("block").parquet(path)
    found = sorted(r["block"] for r in kept.select("block").distinct().collect())
    return path, found


FOUND = (
    "struct<n_words:bigint,n_hit:bigint,longest:bigint,items:array<string>,"
    "matches:array<struct<first:bigint,words:bigint,item:string>>>"
)


def find_contamination(
    docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, out: str = "found", keep: list[str] | None = None,
) -> DataFrame:
    """``docs``, or its columns ``keep``, with a struct column ``out``.

    Underscores are put before the name ``out`` while a column has it.

    ``n_hit`` counts words inside any occurrence of a window, ``items`` are the sorted ids (as text)
    of test texts with an occurring window, ``matches`` the longest verbatim match from each place that
    the match before does not hold, as first word, words and an item, ``longest`` the longest. Repeated rows get equal results. Without test texts,
    every document is clean. Test texts with a null id are left out.
    """
    keep = docs.columns if keep is None else keep
    while out in keep:
        out = "_" + out
    path, blocks = store_tests(bench, item_id, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([
            ("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()), ("items", pa.list_(pa.string())),
            ("matches", pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("item", pa.string())]))),
        ])
        for whole in batches:
            for batch in pieces(whole, text, SHARD_BYTES):
                words, hits = scan(batch, text, path, blocks, window)
                n_hit = np.bincount(words.row, weights=hits.hit, minlength=batch.num_rows).astype(np.int64)
                rows = [
                    {"n_words": int(w), "n_hit": int(h), "longest": int(m), "items": sorted(i),
                     "matches": [{"first": a, "words": b, "item": c} for a, b, c in sorted(p)]}
                    for w, h, m, i, p in zip(words.counts(), n_hit, hits.longest, hits.items, hits.matches)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(batch.schema.get_field_index(c)) for c in keep], pa.array(rows, kind)],
                    names=[*keep, out])

    read = docs.select(*dict.fromkeys([*keep, text]))
    return read.mapInArrow(run, ddl([*struct_fields(docs.select(*keep)), (out, FOUND)]))


def remove_contaminated(
    docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` in which no window of a test text occurs, with their columns as they are."""
    path, blocks = store_tests(bench, item_id, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, text, SHARD_BYTES):
                _, hits = scan(batch, text, path, blocks, window)
                yield batch.filter(pa.array(hits.longest == 0))

    return docs.mapInArrow(run, docs.schema)
