"""Secrets in texts and in what is wrapped in them.

Every text is scanned by fixed rules. Then a worklist unwraps layers: escapes (per cent and Unicode
ones), base64, and compressed bytes inside either, each layer scanned again and put on the list
until nothing new appears. A layer's characters remember the part of the text they came from, so a
secret found five layers down is reported as a span of the text itself. A layer that was met before
at the same place (a cycle, or two ways to one content) is not opened again.

A layer of escapes is the whole text without them, since a rule may begin before an escape and end
behind it. Work on one text stays near linear: base64 shrinks a layer by a quarter, ``%25`` repeated
is one escape, and a chain of more than ``ESCAPES`` escape layers is finished in one pass.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.llm.shared import ddl, pieces, struct_fields

KINDS = ("assign", "access", "hex")
ESCAPES = 8  # escape layers in a row that are scanned one by one
MOST_BYTES = 1 << 24  # decompressed for one text; what goes beyond is cut there and marked

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of 32 or more, begun only where a run begins and never given back: the same matches in linear time.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")

_BYTE_ESCAPE = r"%(?:25)*[0-9A-Fa-f]{2}|\\x[0-9A-Fa-f]{2}"
_ESCAPE = re.compile(rf"(?:{_BYTE_ESCAPE})+|\\u\{{[0-9A-Fa-f]{{1,6}}\}}|(?:\\u[0-9A-Fa-f]{{4}})+|\\U[0-9A-Fa-f]{{8}}")
_ONE_BYTE = re.compile(_BYTE_ESCAPE)
# lines of equal length with a shorter last one, or one run of 16 characters or more
_BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:(?:[A-Za-z0-9+/]{60,76}\r?\n)++(?:[A-Za-z0-9+/]{1,76}+={0,2})?|[A-Za-z0-9+/_-]{16,}+={0,2})")
_CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f�]")


def base_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) by the fixed rules, in code points, by start, then kind."""
    out = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


@dataclass
class Layer:
    text: str
    start: np.ndarray | int  # per character, where what it came from begins in the text; one number if all came from one span
    end: np.ndarray | int
    path: tuple[str, ...]

    def span(self, a: int, b: int) -> tuple[int, int]:
        if isinstance(self.start, np.ndarray):
            return int(self.start[a]), int(self.end[b - 1])
        return self.start, self.end

    def escapes(self) -> int:
        """Escape layers at the end of the path."""
        n = 0
        while n < len(self.path) and self.path[-1 - n] == "escape":
            n += 1
        return n

    def key(self) -> tuple:
        place = (self.start, self.end)
        if isinstance(self.start, np.ndarray):
            place = (hashlib.sha256(self.start.tobytes()).digest(), hashlib.sha256(self.end.tobytes()).digest())
        return hashlib.sha256(self.text.encode("utf-8", "surrogatepass")).digest(), *place


def _byte_chars(data: bytes) -> list[tuple[str, int, int]]:
    """(character, first byte, end byte) of UTF-8 bytes; a byte that is none stands for itself."""
    out, at = [], 0
    while at < len(data):
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
        try:
            char = data[at : at + size].decode("utf-8")
        except UnicodeDecodeError:
            char, size = chr(lead), 1
        out.append((char, at, at + size))
        at += size
    return out


def _unescaped(run: str) -> list[tuple[str, int, int]]:
    """(character, start, end) of one match of ``_ESCAPE``; places count from the start of the run."""
    if run[1] in "uU":
        if run[1] == "U" or run[2] == "{":
            code = int(run[2:].strip("{}"), 16)
            return [(chr(code), 0, len(run))] if code < 0x110000 and not 0xD800 <= code < 0xE000 else [(c, i, i + 1) for i, c in enumerate(run)]
        units = [int(run[i + 2 : i + 6], 16) for i in range(0, len(run), 6)]
        out, at = [], 0
        while at < len(units):
            pair = 0xD800 <= units[at] < 0xDC00 and at + 1 < len(units) and 0xDC00 <= units[at + 1] < 0xE000
            if pair:
                out.append((chr(0x10000 + ((units[at] - 0xD800) << 10) + units[at + 1] - 0xDC00), 6 * at, 6 * at + 12))
            elif 0xD800 <= units[at] < 0xE000:
                out += [(c, 6 * at + i, 6 * at + i + 1) for i, c in enumerate(run[6 * at : 6 * at + 6])]
            else:
                out.append((chr(units[at]), 6 * at, 6 * at + 6))
            at += 2 if pair else 1
        return out
    marks = [(m.start(), m.end()) for m in _ONE_BYTE.finditer(run)]
    chars = _byte_chars(bytes(int(run[b - 2 : b], 16) for _, b in marks))
    return [(char, marks[a][0], marks[b - 1][1]) for char, a, b in chars]


def _replace(layer: Layer, runs: Iterator[tuple[int, int, list[tuple[str, int, int]]]]) -> Layer:
    """The layer with each run (start, end, characters with places in the layer) in place of what was there."""
    texts, places, at = [], [], 0
    for a, b, chars in runs:
        texts += [layer.text[at:a], "".join(c for c, _, _ in chars)]
        plain = np.arange(at, a)
        places += [np.stack([plain, plain + 1]), np.array([(x, y) for _, x, y in chars], np.int64).reshape(-1, 2).T]
        at = b
    plain = np.arange(at, len(layer.text))
    texts.append(layer.text[at:])
    first, last = np.concatenate([*places, np.stack([plain, plain + 1])], axis=1).astype(np.int64)
    if isinstance(layer.start, np.ndarray):
        first, last = layer.start[first], layer.end[last - 1]
    else:
        first = last = None
    text = "".join(texts)
    return Layer(text, layer.start if first is None else first, layer.end if last is None else last, (*layer.path, "escape"))


def unescape(layer: Layer) -> Layer | None:
    """One layer of escapes taken off, or None if there are none."""
    runs = [(m.start(), m.end(), [(c, m.start() + a, m.start() + b) for c, a, b in _unescaped(m.group())])
            for m in _ESCAPE.finditer(layer.text)]
    changed = [(a, b, chars) for a, b, chars in runs if len(chars) < b - a]
    return _replace(layer, iter(changed)) if changed else None


_TAIL = re.compile(r"(?:%[0-9A-Fa-f]{2}|\\x[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\})\Z")


def unescape_all(layer: Layer) -> Layer | None:
    """All layers of escapes taken off in one pass: a character that ends an escape closes it at once.

    A byte above 127 stays the character of that number.
    """
    out: list[tuple[str, int, int]] = []
    changed = False
    for i, char in enumerate(layer.text):
        out.append((char, i, i + 1))
        while out[-1][0] in "0123456789abcdefABCDEF}":
            tail = _TAIL.search("".join(c for c, _, _ in out[-10:]))
            code = int(re.sub(r"^(?:%|\\[xuU])|[{}]", "", tail.group()), 16) if tail else -1
            if not 0 <= code < 0x110000 or 0xD800 <= code < 0xE000:
                break
            taken = out[-len(tail.group()) :]
            out[-len(tail.group()) :] = [(chr(code), taken[0][1], taken[-1][2])]
            changed = True
    return _replace(layer, iter([(0, len(layer.text), out)])) if changed else None


def decompress(data: bytes, most: int = MOST_BYTES) -> tuple[str, bytes, bool] | None:
    """(format, content, cut) of gzip, zlib, bzip2, xz or zstandard bytes; None for others. Broken ends are left off."""
    if data[:2] == b"\x1f\x8b":
        name, reader = "gzip", zlib.decompressobj(31)
    elif data[:1] == b"\x78" and len(data) > 2 and (data[0] * 256 + data[1]) % 31 == 0:
        name, reader = "zlib", zlib.decompressobj(15)
    elif data[:3] == b"BZh":
        name, reader = "bzip2", bz2.BZ2Decompressor()
    elif data[:6] == b"\xfd7zXZ\x00":
        name, reader = "xz", lzma.LZMADecompressor(memlimit=1 << 28)
    elif data[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard

        try:
            body = zstandard.ZstdDecompressor(max_window_size=1 << 27).stream_reader(data).read(most + 1)
        except (zstandard.ZstdError, MemoryError):
            return None
        return ("zstd", body[:most], len(body) > most) if body else None
    else:
        return None
    try:
        body = reader.decompress(data, most + 1)
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        return None
    return (name, body[:most], len(body) > most) if body else None


def _as_text(data: bytes) -> str | None:
    """``data`` as text if it reads like one."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and not _CONTROL.search(text) else None


class Budget:
    """Bytes that may still be decompressed for a text, and whether they were too few."""

    def __init__(self, most: int):
        self.left, self.cut = most, False

    def decompress(self, data: bytes) -> tuple[str, bytes] | None:
        inner = decompress(data, self.left)
        if inner is None:
            return None
        self.left -= len(inner[1])
        self.cut |= inner[2]
        return inner[:2]


def _opened(data: bytes, name: str, layer: Layer, place: tuple[int, int], budget: Budget) -> Layer | None:
    """The layer of bytes that something was decoded to: text, or compressed text, however often."""
    path, met = (*layer.path, name), set()
    while (inner := budget.decompress(data)) is not None:
        met.add(hashlib.sha256(data).digest())
        kind, data = inner
        path = (*path, kind)
        if hashlib.sha256(data).digest() in met:  # it unpacks to itself
            return None
    text = data.decode("utf-8", "replace") if met else _as_text(data)
    return Layer(text, *place, path) if text else None


def _base64_bytes(run: str) -> bytes | None:
    body = re.sub(r"\s|=", "", run).replace("-", "+").replace("_", "/")
    body = body[: len(body) - 1] if len(body) % 4 == 1 else body
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None


def unwrapped(layer: Layer, budget: Budget) -> Iterator[Layer]:
    """The layers directly inside ``layer``."""
    text = layer.text
    if "%" in text or "\\" in text:
        for m in _ESCAPE.finditer(text):  # bytes that are compressed are a layer of their own
            if m.end() - m.start() >= 30 and m.group()[1] not in "uU":
                data = bytes(int(x.group()[-2:], 16) for x in _ONE_BYTE.finditer(m.group()))
                if decompress(data, 1):
                    yield _opened(data, "escape", layer, layer.span(m.start(), m.end()), budget)
        yield unescape_all(layer) if layer.escapes() >= ESCAPES else unescape(layer)
    for m in _BASE64.finditer(text):
        # the word behind the last full line may belong to the text
        for run in dict.fromkeys((m.group(), m.group().rpartition("\n")[0] or m.group())):
            data = _base64_bytes(run)
            if data and (decompress(data, 1) or _as_text(data)):
                yield _opened(data, "base64", layer, layer.span(m.start(), m.start() + len(run)), budget)
                break


def all_secrets(text: str, most: int = MOST_BYTES) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, str]], bool]:
    """Base spans, further spans (start, end, kind, path of layers), and whether a layer was cut."""
    base = base_secrets(text)
    if not (("%" in text or "\\" in text) and _ESCAPE.search(text)) and not _BASE64.search(text):
        return base, [], False
    places = np.arange(len(text), dtype=np.int64)
    todo = deque([Layer(text, places, places + 1, ())])
    met, known, found, budget = {todo[0].key()}, set(base), {}, Budget(most)
    while todo:
        layer = todo.popleft()
        if layer.path:
            for a, b, kind in base_secrets(layer.text):
                place = (*layer.span(a, b), kind)
                if place not in known:
                    known.add(place)
                    found[place] = ">".join(layer.path)
        for inner in unwrapped(layer, budget):
            if inner is not None and (key := inner.key()) not in met:
                met.add(key)
                todo.append(inner)
    return base, sorted(((a, b, k, path) for (a, b, k), path in found.items()), key=lambda s: (s[0], s[2], s[1])), budget.cut


SPAN = "struct<start:bigint,end:bigint,kind:int,path:string>"


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found, cut) of every row of ``docs``; a null text is empty.

    ``found`` are the spans, by start, then kind, then end, each with the path of layers it was found
    in (empty for the text itself); ``cut`` tells that more than ``MOST_BYTES`` would have
    had to be decompressed for it. A span is
    reported once, by the first layer that shows it. Repeated rows get the same spans.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("path", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                spans, cuts = [], []
                for body in batch.column(1).to_pylist():
                    base, more, cut = all_secrets(body or "")
                    rows = sorted([(a, k, b, "") for a, b, k in base] + [(a, k, b, path) for a, b, k, path in more])
                    spans.append([{"start": a, "end": b, "kind": k, "path": path} for a, k, b, path in rows])
                    cuts.append(cut)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kinds), pa.array(cuts)], names=["doc_id", "found", "cut"])

    return read.mapInArrow(run, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, found array<{SPAN}>, cut boolean")


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a secret, wrapped ones included, replaced by ``mark``; nulls stay."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            clean = []
            for body in frame[text]:
                if isinstance(body, str):
                    base, more, _ = all_secrets(body)
                    parts, at = [], 0
                    for start, end in sorted([s[:2] for s in base] + [s[:2] for s in more]):
                        if end > at:
                            if start >= at:
                                parts += [body[at:start], mark]
                            at = end
                    body = "".join([*parts, body[at:]])
                clean.append(body)
            yield frame.assign(**{text: clean})

    return docs.mapInPandas(run, ddl(struct_fields(docs)))
