"""Helpers of the training-data operators: words of Arrow text columns, stored tables, bit filters."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayplan.session import Scratch

__all__ = ["Scratch", "table"]

# Words: runs of digits, lower-cased letters and every byte of a non-ASCII character.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_IN_WORD[65:91] = True

PIECE_BYTES = 1 << 20  # text bytes that one numpy pass works on; it takes some 60 times as much memory

# Python workers are reused: what an operator keeps in one from task to task is dropped by the next operator.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(owner: str, drop: Callable[[], None]) -> None:
    _KEPT[owner] = drop


def enter(owner: str) -> None:
    """To be called at the start of a task that needs much memory.

    Drops what other operators left in this worker and gives free memory, which the allocators of
    Arrow and C keep, back to the machine.
    """
    for name in [n for n in _KEPT if n != owner]:
        _KEPT.pop(name)()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit mix (splitmix64 finaliser) of ``x`` xor a salt-derived constant."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


_CHAR = mix(np.arange(256, dtype=np.uint64), 7)
_BASE = 0x5851F42D4C957F2D
_BASE_INV = pow(_BASE, -1, 2**64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, _BASE, np.uint64))
        down = np.cumprod(np.full(n, _BASE_INV, np.uint64))
    return up, down


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(ends):
        ends = np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` bytes of text, or one longer row."""
    if not batch.num_rows:
        return
    _, ends = text_bytes(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
        stop = max(stop, at + 1)
        yield batch.slice(at, stop - at)
        at = stop


class Words:
    """Words of a text column: byte range, row and 64-bit hash each, in order of place."""

    def __init__(self, column: pa.Array):
        data, self.offsets = text_bytes(column)
        self.rows, self.data = len(self.offsets) - 1, data
        n = len(data)
        if not n:
            self.start = self.end = self.row = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        inside = _IN_WORD[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(self.offsets, self.start, side="right") - 1
        up, down = _powers(max(n, PIECE_BYTES))
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(_CHAR[_LOWER[data]] * up[:n], out=total[1:])
            self.hash = mix((total[self.end] - total[self.start]) * down[self.start])

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows).astype(np.int64)

    def text(self, i: int) -> str:
        return _LOWER[self.data[self.start[i] : self.end[i]]].tobytes().decode("utf-8", "replace")


def grouped_sum(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=rows)


def struct_fields(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in fields)


BLOOM_BITS = 1 << 25  # 4 MB at most reach the driver and each worker


def bit_filter(hashes: DataFrame, bits: int = BLOOM_BITS) -> bytes:
    """A one-hash bit filter over the single bigint column of ``hashes``.

    It has ``bits`` bits whatever the input: a full filter only lets more rows through, and
    every use is followed by an exact join. The bits are or-ed per 64-bit word by Spark.
    """
    (name,) = hashes.columns
    place = F.pmod(F.col(name), F.lit(bits))
    words = (
        hashes.select(F.floor(place / 64).cast("int").alias("w"), (place % 64).cast("int").alias("b"))
        .select("w", F.expr("shiftleft(cast(1 as bigint), b)").alias("m"))
        .groupBy("w").agg(F.bit_or("m").alias("m"))
    )
    out = np.zeros(bits // 64, np.int64)
    for batch in words.toLocalIterator(prefetchPartitions=True):
        out[batch["w"]] = batch["m"]
    return out.tobytes()


def in_filter(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which signed 64-bit ``hashes`` may be in the filter."""
    words = np.frombuffer(bits, np.uint64)
    place = np.mod(hashes.astype(np.int64), len(words) * 64)
    return (words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
