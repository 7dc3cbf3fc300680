"""Personal data and the terms that give it away.

Protected entities are emails, addresses of machines, card and phone numbers, found by fixed rules.
Terms near an entity are counted with it over the whole corpus, by documents. A term discloses an
entity by their pointwise mutual information as a share of the entity's own information: 1 if the
term occurs with the entity only. Terms above a threshold are generalised, above a second one
removed, wherever they occur.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.llm.shared import Scratch, Words, bit_filter, ddl, in_filter, mix, pieces, struct_fields

KINDS = ("email", "ip", "card", "phone")
NEAR = 6  # words on each side of an entity that are held against it
SUPPORT = 2  # documents in which a term is near an entity before it can disclose it
GENERALISE = 0.85  # share of an entity's information
REMOVE = 0.95
MIN_BYTES = 3  # shorter terms are not counted
HELD_TERMS = 1 << 20  # counts that a task holds, up to twice as many for a moment

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs, begun only where a run of digits begins: the same matches in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain.part; every step goes from one @ to the next."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def entities(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, value) in code points, by start, then kind."""
    out = []
    if "@" in text:
        out += [(a, b, 0, text[a:b].lower()) for a, b in emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            out.append((m.start(), m.end(), 1, ".".join(p or "0" for p in parts)))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2, digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = _NO_DIGIT.sub("", m.group())
            if 9 <= len(digits) <= 15:
                out.append((m.start(), m.end(), 3, digits))
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


def _hash(kind: int, value: str) -> int:
    data = np.frombuffer(value.encode("utf-8", "replace"), np.uint8).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = mix(data + (np.arange(1, len(data) + 1, dtype=np.uint64) << np.uint64(8)), 90 + kind).sum(dtype=np.uint64)
    return int(mix(np.array([key]), 91).view(np.int64)[0])


def _read(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text"))


def find_entities(read: DataFrame) -> DataFrame:
    """(doc_id, key, found, near) per row: entity spans, and distinct (entity, term) pairs near each other."""
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))
    pairs = pa.list_(pa.struct([("e", pa.int64()), ("t", pa.int64())]))

    def near(column: pa.Array, rows: list[int], texts: list[str], found: list[list]) -> list[list[dict]]:
        words = Words(column.take(pa.array(rows)))
        size = words.end - words.start
        out = []
        for i, row in enumerate(rows):
            low = int(np.searchsorted(words.row, i))
            high = int(np.searchsorted(words.row, i + 1))
            seen = set()
            for start, end, kind, value in found[row]:
                begin = int(words.offsets[i]) + len(texts[row][:start].encode())
                stop = begin + len(texts[row][start:end].encode())
                a = low + int(np.searchsorted(words.end[low:high], begin, side="right"))
                b = low + int(np.searchsorted(words.start[low:high], stop, side="left"))
                name = _hash(kind, value)
                for w in (*range(max(low, a - NEAR), a), *range(b, min(high, b + NEAR))):
                    if size[w] >= MIN_BYTES:
                        seen.add((name, int(words.hash[w].astype(np.int64))))
            out.append([{"e": e, "t": t} for e, t in sorted(seen)])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                texts = [t or "" for t in batch.column(2).to_pylist()]
                found = [entities(t) for t in texts]
                rows = [i for i, f in enumerate(found) if f]
                context = [[] for _ in texts]
                if rows:
                    for i, c in zip(rows, near(batch.column(2), rows, texts, found)):
                        context[i] = c
                spans = [[{"start": a, "end": b, "kind": k} for a, b, k, _ in f] for f in found]
                names = [sorted({_hash(k, v) for _, _, k, v in f}) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(spans, kinds), pa.array(names, pa.list_(pa.int64())),
                     pa.array(context, pairs)], names=["doc_id", "key", "found", "names", "near"])

    return read.mapInArrow(
        run, "doc_id bigint, key bigint, found array<struct<start:bigint,end:bigint,kind:int>>, names array<bigint>, "
             "near array<struct<e:bigint,t:bigint>>")


def count_terms(read: DataFrame, terms: DataFrame) -> DataFrame:
    """(t, n): documents in which each of ``terms`` (t) occurs, and few other terms.

    A bit filter of fixed size keeps words out that are in no entity's neighbourhood. A task adds up
    its texts before the shuffle; whenever it holds HELD_TERMS different ones it gives them out.
    """
    bits = read.sparkSession.sparkContext.broadcast(bit_filter(terms.select("t")))

    def added(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        hashes, which = np.unique(np.concatenate([h for h, _ in counts]), return_inverse=True)
        return hashes, np.bincount(which, np.concatenate([n for _, n in counts]), len(hashes)).astype(np.int64)

    def rows(counts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for hashes, n in counts:
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], names=["t", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for batch in pieces(whole, "text"):
                words = Words(batch.column(0))
                may = np.flatnonzero(in_filter(bits.value, words.hash.view(np.int64)))
                hashes, which = np.unique(words.hash[may], return_inverse=True)
                pair = np.unique(which * words.rows + words.row[may]) // max(1, words.rows)
                held.append((hashes, np.bincount(pair, minlength=len(hashes))))
                size += len(hashes)
                if size > 2 * HELD_TERMS:
                    held = [added(held)]
                    size = len(held[0][0])
                    if size > HELD_TERMS:
                        yield from rows(held)
                        held, size = [], 0
        if held:
            yield from rows([added(held)])

    return read.select("text").mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n"))


def place_terms(read: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, key, t, start, end) of every occurrence of ``terms`` (t), and few others, in code points."""
    bits = read.sparkSession.sparkContext.broadcast(bit_filter(terms.select("t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, "text"):
                words = Words(batch.column(2))
                may = np.flatnonzero(in_filter(bits.value, words.hash.view(np.int64)) & (words.end - words.start >= MIN_BYTES))
                if not len(may):
                    continue
                points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
                row = words.row[may]
                base = points[words.offsets[row]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                     pa.array(words.hash[may].view(np.int64)), pa.array(points[words.start[may]] - base),
                     pa.array(points[words.end[may]] - base)], names=["doc_id", "key", "t", "start", "end"])

    return read.mapInArrow(run, "doc_id bigint, key bigint, t bigint, start bigint, end bigint")


def disclosing_terms(found: DataFrame, read: DataFrame, scratch: Scratch, support: int, least: float) -> DataFrame:
    """(t, share): terms that give away an entity, with the largest share of an entity's information.

    share = log(N n(e,t) / n(e) n(t)) / log(N / n(e)), all counts in documents. An entity that is in every document has no
    information to disclose. Pairs are counted with map-side combine; an entity or term in a third of
    all documents is few rows when it moves. Only pairs that would pass if their term occurred nowhere
    but near entities (n_near documents, at most n(t)) need their term counted over the corpus.
    """
    total = float(max(found.count(), 1))
    own = F.log(F.lit(total) / F.col("n_e"))

    def share(n_t: str):
        return F.log(F.lit(total) * F.col("n_et") / (F.col("n_e") * F.col(n_t))) / own

    pairs = (
        found.select(F.explode("near").alias("p")).groupBy("p.e", "p.t").agg(F.count("*").alias("n_et"))
        .where(F.col("n_et") >= support)
    )
    names = found.select(F.explode("names").alias("ee")).groupBy("ee").agg(F.count("*").alias("n_e"))
    nearby = (
        found.select(F.explode(F.array_distinct(F.transform("near", lambda p: p["t"]))).alias("tn"))
        .groupBy("tn").agg(F.count("*").alias("n_near"))
    )
    possible = scratch.write(
        pairs.join(names, F.col("e") == F.col("ee")).join(nearby, F.col("t") == F.col("tn"))
        .where((own > 0) & (share("n_near") >= least)).select("t", "n_et", "n_e"), "pairs")
    terms = count_terms(read, possible.select("t").distinct()).select(F.col("t").alias("tt"), F.col("n").alias("n_t"))
    return (
        possible.join(terms, F.col("t") == F.col("tt"))
        .groupBy("t").agg(F.max(share("n_t")).alias("share")).where(F.col("share") >= least)
    )


def find_disclosures(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: int = SUPPORT,
    generalise: float = GENERALISE, remove: float = REMOVE,
) -> DataFrame:
    """(doc_id, key, found, terms) of every row of ``docs``; key is xxhash64 of the text.

    ``found`` are the entities, ``terms`` structs (start, end, action) of disclosing terms outside
    them, in order. A null text is empty. Repeated rows get the same spans.
    """
    scratch = Scratch(docs.sparkSession, "disclosure")
    read = _read(docs, doc_id, text)
    found = scratch.write(find_entities(read), "entities")
    terms = scratch.write(disclosing_terms(found, read, scratch, support, generalise), "terms")
    action = F.when(F.col("share") >= remove, "remove").otherwise("generalise")
    spans = (
        place_terms(read, terms).join(terms.select(F.col("t").alias("tt"), action.alias("action")), F.col("t") == F.col("tt"))
        .groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k"))
        .agg(F.sort_array(F.collect_set(F.struct("start", "end", "action"))).alias("all"))
    )
    outside = F.filter(
        F.coalesce("all", F.expr("cast(array() as array<struct<start:bigint,end:bigint,action:string>>)")),
        lambda s: ~F.exists("found", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    return found.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left").select(
        "doc_id", "key", "found", outside.alias("terms"))


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with entities and generalised terms replaced by their class and removed terms left out."""
    spans = find_disclosures(docs, doc_id, text, **settings).dropDuplicates(["doc_id", "key"]).where(
        "size(found) + size(terms) > 0").select(
        F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("found").alias("_found"), F.col("terms").alias("_terms"))
    columns = docs.columns
    joined = docs.join(
        spans, F.col(doc_id).cast("bigint").eqNullSafe(F.col("_d")) & (F.xxhash64(F.col(text)) == F.col("_k")), "left").drop("_d", "_k")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            clean = []
            for body, found, terms in zip(frame[text], frame["_found"], frame["_terms"]):
                if found is not None and isinstance(body, str):
                    marks = [(s["start"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in found]
                    marks += [(s["start"], s["end"], "" if s["action"] == "remove" else "[TERM]") for s in terms]
                    parts, at = [], 0
                    for start, end, mark in sorted(marks):
                        if end > at:
                            parts += [body[at : max(start, at)], mark]
                            at = end
                    body = "".join([*parts, body[at:]])
                clean.append(body)
            yield frame.assign(**{text: clean})[columns]

    return joined.mapInPandas(run, ddl(struct_fields(docs)))
