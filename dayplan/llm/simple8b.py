"""Token ids in word-aligned Simple-8b files.

Each 64-bit word holds a 4-bit selector and 60 payload bits: so many ids of so many bits. Ids of
more than 60 bits are escaped: a word with selector 0, then the id as it is. Words are cut into
blocks of a fixed count of ids, and the word offset of every block is kept, so any block can be
decoded on its own, and many at once in numpy. Packing walks all blocks of a run side by side.

File: the words; word offset of each block (u64, one more than blocks); the documents' row keys
(i64) and null marks (u8); ids per document (u64); then a trailer of five u64: documents, ids,
words, block size, magic number. All little-endian.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayplan.llm.files import new_file, open_file
from dayplan.llm.shared import Scratch
from dayplan.llm.tokens import TOKENIZER, encoder, text_runs

BLOCK = 1024
MAGIC = 0x3130_4238_5331_4454
# Selector: ids in a word and bits of each (fixed values of the format; 0 is the escape).
COUNT = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)
_WIDTH = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``ids`` and the words of each block."""
    ids = ids.astype(np.uint64)
    blocks = -(-len(ids) // block)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    width = block + int(COUNT.max())
    padded = np.zeros((blocks, width), np.uint64)
    flat = np.zeros(blocks * block, np.uint64)
    flat[: len(ids)] = ids
    padded[:, :block] = flat.reshape(blocks, block)
    small = int(ids.max()) < len(_WIDTH)
    need = _WIDTH[padded] if small else np.searchsorted(_POWERS, padded, side="right").astype(np.uint8)
    # the best selector at every place: the one with most ids whose widest id fits
    best = np.where(need > 60, 0, 15).astype(np.uint8)
    most, seen = need.copy(), 1
    for selector in range(14, 0, -1):
        while seen < COUNT[selector]:
            step = min(seen, int(COUNT[selector]) - seen)
            most[:, : width - step] = np.maximum(most[:, : width - step], most[:, step:])
            seen += step
        best[most <= BITS[selector]] = selector
    length = np.full(blocks, block, np.int64)
    length[-1] = len(ids) - (blocks - 1) * block
    used = np.zeros((blocks, width), bool)
    at, live = np.zeros(blocks, np.int64), np.arange(blocks)
    while len(live):
        used[live, at[live]] = True
        at[live] += COUNT[best[live, at[live]]]
        live = live[at[live] < length[live]]
    begin = np.flatnonzero(used.ravel())
    selector = best.ravel()[begin]
    words_at = np.cumsum(1 + (selector == 0)) - (1 + (selector == 0))
    out = np.zeros(len(begin) + int((selector == 0).sum()), np.uint64)
    values = padded.ravel()
    for s in np.unique(selector):
        mine = begin[selector == s]
        if s == 0:
            out[words_at[selector == 0] + 1] = values[mine]
            continue
        word = np.full(len(mine), np.uint64(s) << np.uint64(60))
        for k in range(int(COUNT[s]) if BITS[s] else 0):
            word |= values[mine + k] << np.uint64(k * int(BITS[s]))
        out[words_at[selector == s]] = word
    row = begin // width
    return out, np.bincount(row, weights=1 + (selector == 0), minlength=blocks).astype(np.int64)


def decode(words: np.ndarray, offsets: np.ndarray, total: int, block: int = BLOCK) -> np.ndarray:
    """The ``total`` ids of whole blocks; ``offsets`` are the blocks' word offsets and the end."""
    if not total:
        return np.zeros(0, np.uint64)
    blocks = len(offsets) - 1
    selector = (words >> np.uint64(60)).astype(np.int64)
    # in a run of words that look like escapes, every second one is an escaped id
    zero = selector == 0
    first = np.zeros(len(words), bool)
    first[offsets[:-1]] = True
    index = np.arange(len(words))
    opens = zero & (first | np.concatenate([[True], ~zero[:-1]]))
    run = np.maximum.accumulate(np.where(opens, index, -1))
    head = zero & ((index - run) % 2 == 0)
    raw = np.concatenate([[False], head[:-1]])
    count = np.where(raw, 1, np.where(head, 0, COUNT[selector]))
    ends = np.cumsum(count)
    row = np.repeat(np.arange(blocks), np.diff(offsets))
    before = np.concatenate([[0], ends])[offsets[:-1]]
    place = ends - count - before[row]
    width = block + int(COUNT.max())
    out = np.zeros(blocks * width, np.uint64)
    place += row * width
    out[place[raw]] = words[raw]
    for s in range(2, 16):
        mine = np.flatnonzero((selector == s) & ~raw)
        if not len(mine):
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(int(COUNT[s])):
            out[place[mine] + k] = (words[mine] >> np.uint64(k * int(BITS[s]))) & mask
    return out.reshape(blocks, width)[:, :block].ravel()[:total]


def write_file(folder: str, partition: int, runs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]],
               block: int = BLOCK) -> tuple[str, int, int]:
    """Write runs of (keys, null marks, ids per document, ids); returns name, documents and ids."""
    name, sink = new_file(folder, partition)
    keys, nulls, sizes, per_block = [], [], [], []
    rest, total = np.zeros(0, np.uint64), 0
    with sink:
        def put(ids: np.ndarray) -> None:
            words, used = encode(ids, block)
            per_block.append(used)
            sink.write(words.astype("<u8").tobytes())

        for key, null, size, ids in runs:
            keys.append(key)
            nulls.append(null)
            sizes.append(size)
            total += len(ids)
            ids = np.concatenate([rest, ids.astype(np.uint64)])
            whole = len(ids) // block * block
            put(ids[:whole])
            rest = ids[whole:]
        put(rest)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(per_block))])
        docs = sum(map(len, keys))
        for values, kind in ((offsets, "<u8"), (np.concatenate([np.zeros(0, np.int64), *keys]), "<i8"),
                             (np.concatenate([np.zeros(0, np.uint8), *nulls]), "u1"),
                             (np.concatenate([np.zeros(0, np.int64), *sizes]), "<u8"),
                             (np.array([docs, total, offsets[-1], block, MAGIC]), "<u8")):
            sink.write(values.astype(kind).tobytes())
    return name, docs, total


def read_file(folder: str, name: str, run_ids: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list]]:
    """Runs of (keys, null marks, ids per document, list of id arrays), a few blocks at a time."""
    with open_file(folder, name) as source:
        size = source.size()
        docs, total, n_words, block, magic = np.frombuffer(source.read_at(40, size - 40), "<u8").astype(np.int64)
        if magic != MAGIC:
            raise ValueError(f"{name} is not a token file")
        blocks = -(-int(total) // int(block))
        at = int(n_words) * 8

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            n_bytes = n * np.dtype(kind).itemsize
            out = np.frombuffer(source.read_at(n_bytes, at), kind)
            at += n_bytes
            return out

        offsets = take(blocks + 1, "<u8").astype(np.int64)
        keys, nulls, sizes = take(int(docs), "<i8"), take(int(docs), "u1"), take(int(docs), "<u8").astype(np.int64)
        ends = np.cumsum(sizes)
        done = 0
        while done < docs:
            start = int(ends[done] - sizes[done])
            stop = max(int(np.searchsorted(ends, start + run_ids, side="right")), done + 1)
            end = int(ends[stop - 1])
            first, last = start // block, -(-end // block)
            words = np.frombuffer(
                source.read_at(int(offsets[last] - offsets[first]) * 8, int(offsets[first]) * 8), "<u8")
            ids = decode(words, offsets[first : last + 1] - offsets[first],
                         int(min(total, last * block) - first * block), int(block))
            ids = ids[start - first * block : end - first * block]
            yield keys[done:stop], nulls[done:stop], sizes[done:stop], np.split(ids, np.cumsum(sizes[done:stop])[:-1])
            done = stop


def write_tokens(
    docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
    end_id: int = 0, scratch: Scratch | None = None,
) -> DataFrame:
    """Write the ids of all texts in order of doc_id; returns the stored manifest, a row per file.

    Rows are range partitioned by doc_id and, where it repeats, a hash of the text, so no value
    gathers in one task. A null doc_id comes first, a null text is empty. Every document ends with
    ``end_id``.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "simple8b")
    tie = F.xxhash64(text)
    ordered = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), tie.alias("tie"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = TaskContext.get().partitionId()
        coder = encoder(tokenizer)
        tail = np.array([end_id], coder.dtype).tobytes()

        def runs():
            for frame in batches:
                texts = frame["text"].tolist()
                nulls = frame["doc_id"].isna().to_numpy()
                keys = frame["doc_id"].fillna(0).to_numpy(np.int64)
                for a, b in text_runs(texts):
                    ids = [found + tail for found in coder.ids([t if isinstance(t, str) else "" for t in texts[a:b]])]
                    size = np.array([len(x) for x in ids], np.int64) // coder.dtype.itemsize
                    yield keys[a:b], nulls[a:b], size, np.frombuffer(b"".join(ids), coder.dtype)

        name, count, total = write_file(folder, pid, runs())
        yield pd.DataFrame({"part": [pid], "name": [name], "n_docs": [count], "n_ids": [total]})

    manifest = ordered.mapInPandas(run, "part int, name string, n_docs bigint, n_ids bigint")
    return scratch.write(manifest, "manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    Files are spread over tasks; a file's first id follows the ids of the files before it, summed
    over the manifest, which has one short row per file.
    """
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.where("n_docs > 0").withColumn("base", F.coalesce(before, F.lit(0)))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for name, base in zip(frame["name"], frame["base"]):
                at = int(base)
                for keys, nulls, sizes, ids in read_file(folder, name):
                    out = pd.DataFrame({
                        "doc_id": pd.array(keys, "Int64"), "start": at + np.cumsum(sizes) - sizes, "n_tokens": sizes,
                        "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                    })
                    out.loc[nulls.astype(bool), "doc_id"] = pd.NA
                    at += int(sizes.sum())
                    yield out

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return files.select("name", "base").repartition(n).mapInPandas(run, schema)


def token_round_trip(docs: DataFrame, **names) -> DataFrame:
    """Write the token files of ``docs`` in the shared folder and read every document back."""
    scratch = Scratch(docs.sparkSession, "simple8b")
    folder = f"{scratch.root}/ids"
    return read_tokens(write_tokens(docs, folder, scratch=scratch, **names), folder)
