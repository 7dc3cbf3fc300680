"""Toxicity of texts after noisy-channel restoration of disguised words.

A disguised word (letters swapped for look-alike signs, repeated, or set apart by separators) is a
lattice: each sign may stand for itself or for letters, a repeat may be one letter or more, a
separator may be nothing. A Viterbi search finds the likeliest word under a character trigram
model whose counts come from all documents, and signs' costs as the channel. Words without such
signs have a single path and stay as they are. The score is a logistic function of the strongest
evidence among the words and word beginnings of the text, original and restored; evidence is the
lower confidence bound of a term's log odds in a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayplan.llm import labels as lab
from dayplan.llm.shared import _LOWER, Scratch, Words, enter, mix, pieces, text_bytes

FOLDS = 5
PREFIXES = (4, 5, 6)  # bytes of word beginnings that count as terms
SUPPORT = 2  # toxic documents a term needs
LEAST = 0.5  # evidence below this is none
BEST = 3  # strongest terms that the score looks at
# Signs and the letters they may stand for (fixed values).
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "#": "h", "(": "c", "<": "c", "€": "e", "¡": "i",
}
SEPARATORS = " .-_*~'"
_SIGN_COST, _DROP_COST, _REPEAT_COST, _KEEP_COST = 0.7, 0.3, 0.5, 3.0

# symbols of the character model: 0 outside words, letters, bytes of other letters
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = np.arange(27, 155)
SYMBOLS = 155
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_ASCII_LETTER = _LETTER.copy()
_ASCII_LETTER[128:] = False
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKALIKES if ord(c) < 128]] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[ord(c) for c in SEPARATORS]] = True
_TOKEN = re.compile(r"\S+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_]|[@$!|+*#(<])(?:[ .\-_*~'](?:[^\W_]|[@$!|+*#(<])){2,}(?![^\W_])")


def count_trigrams(docs: DataFrame, text: str) -> DataFrame:
    """(gram, n): character trigrams of all texts; each task adds its own up before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity")
        total: np.ndarray | None = None
        for whole in batches:
            for batch in pieces(whole, text):
                data, ends = text_bytes(batch.column(0))
                # two symbols of outside around every text, so none is counted together with its neighbour
                symbol = np.zeros(len(data) + 2 * batch.num_rows + 2, np.int32)
                row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
                symbol[np.arange(len(data)) + 2 * row + 2] = _SYMBOL[data]
                gram = (symbol[:-2] * SYMBOLS + symbol[1:-1]) * SYMBOLS + symbol[2:]
                found = np.bincount(gram, minlength=SYMBOLS**3)
                total = found if total is None else total + found
        if total is not None:
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    return docs.select(text).mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


class Channel:
    """Restores disguised words; the model has at most SYMBOLS**3 entries."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.tri = dict(zip(grams.tolist(), counts.tolist()))
        self.bi, self.uni, self.all = {}, {}, 1
        for gram, n in self.tri.items():
            self.bi[gram // SYMBOLS] = self.bi.get(gram // SYMBOLS, 0) + n
            self.uni[gram // SYMBOLS % SYMBOLS] = self.uni.get(gram // SYMBOLS % SYMBOLS, 0) + n
            self.all += n
        self.known: dict[str, str] = {}

    def cost(self, a: int, b: int, c: int) -> float:
        """Minus log probability of symbol c behind a and b, interpolated over shorter contexts."""
        p = 0.05 / SYMBOLS + 0.15 * self.uni.get(c, 0) / self.all
        p += 0.25 * self.bi.get(b * SYMBOLS + c, 0) / (self.uni.get(b, 0) + 1)
        p += 0.55 * self.tri.get((a * SYMBOLS + b) * SYMBOLS + c, 0) / (self.bi.get(a * SYMBOLS + b, 0) + 1)
        return -math.log(p)

    def restore(self, word: str) -> str:
        if word not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[word] = self._viterbi(word)
        return self.known[word]

    def _viterbi(self, word: str) -> str:
        # state: the last two symbols and the last character kept; value: cost and text so far
        states: dict[tuple[int, int, str], tuple[float, tuple]] = {(0, 0, ""): (0.0, ())}
        for char in word.lower():
            fresh: dict[tuple[int, int, str], tuple[float, tuple]] = {}

            def offer(key, cost, path):
                if key not in fresh or cost < fresh[key][0]:
                    fresh[key] = (cost, path)

            options = [(c, _SIGN_COST) for c in LOOKALIKES.get(char, "")]
            if char.isalpha():
                options.append((char, 0.0))
            for (a, b, last), (cost, path) in states.items():
                for letter, price in options:
                    x, y = a, b
                    more = price
                    for byte in letter.encode("utf-8", "replace"):
                        s = int(_SYMBOL[byte])
                        more += self.cost(x, y, s)
                        x, y = y, s
                    offer((x, y, letter), cost + more, (path, letter))
                    if letter == last:  # the same letter once more, meant once
                        offer((a, b, last), cost + price + _REPEAT_COST, path)
                if char in SEPARATORS:
                    offer((a, b, last), cost + _DROP_COST, path)
                if not char.isalpha() and not (char in SEPARATORS):
                    offer((b, 0, char), cost + _KEEP_COST + self.cost(a, b, 0), (path, char))
            # a repeat of look-alikes may multiply states: their number is bounded by letters squared
            states = fresh or states
        end = min(states.items(), key=lambda s: (s[1][0] + self.cost(s[0][0], s[0][1], 0), s[0]))[1][1]
        out = []
        while end:
            end, letter = end
            out.append(letter)
        return "".join(reversed(out))


def suspicious(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows that hold a sign between letters, a letter three times, or single letters set apart."""
    rows = len(ends) - 1
    if len(data) < 3:
        return np.zeros(0, np.int64)
    letter = _ASCII_LETTER[data]
    sign = _SIGN[data]
    at = [np.flatnonzero(letter[:-2] & sign[1:-1] & (letter[2:] | sign[2:])),
          np.flatnonzero(sign[:-2] & letter[1:-1] & sign[2:]),
          np.flatnonzero(letter[:-2] & (_LOWER[data[:-2]] == _LOWER[data[1:-1]]) & (_LOWER[data[:-2]] == _LOWER[data[2:]]))]
    if len(data) > 6:
        unit = letter | sign
        apart = unit.copy()
        apart[1:] &= ~_LETTER[data[:-1]]
        apart[:-1] &= ~_LETTER[data[1:]]
        gap = _SEPARATOR[data]
        at.append(np.flatnonzero(apart[:-4] & gap[1:-3] & apart[2:-2] & gap[3:-1] & apart[4:] & (letter[:-4] | letter[2:-2])))
    found = np.unique(np.concatenate(at))
    return np.unique(np.searchsorted(ends, found, side="right") - 1) if rows and len(found) else np.zeros(0, np.int64)


def _disguised(token: str) -> bool:
    body = token.strip(".,;:!?\"'()[]")
    if not any(c.isalpha() for c in body):
        return False
    if any(c in LOOKALIKES for c in body) and any(c.isalpha() for c in body):
        return True
    return any(body[i] == body[i + 1] == body[i + 2] for i in range(len(body) - 2))


def restored_words(text: str, channel: Channel) -> list[str]:
    """The restored forms of a text's disguised words, in order of place."""
    out = [channel.restore(m.group()) for m in _SPACED.finditer(text)]
    for match in _TOKEN.finditer(text):
        token = match.group()
        if _disguised(token):
            out.append(channel.restore(token.strip(".,;:?\"'()[]")))
    return out


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word and word beginning."""
    row, term = [words.row], [words.hash]
    size = words.end - words.start
    low = _LOWER[words.data]
    for k in PREFIXES:
        long = np.flatnonzero(size > k)
        value = np.zeros(len(long), np.uint64)
        for j in range(k):
            value = (value << np.uint64(8)) | low[words.start[long] + j].astype(np.uint64)
        row.append(words.row[long])
        term.append(mix(value, 80 + k))
    return np.concatenate(row), np.concatenate(term).view(np.int64)


def text_terms(batch: pa.RecordBatch, text: str, channel: Channel) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the terms of original and restored texts."""
    column = batch.column(batch.schema.get_field_index(text))
    row, term = _terms(Words(column))
    data, ends = text_bytes(column)
    rows, texts = [], []
    for i in suspicious(data, ends):
        found = restored_words(column[int(i)].as_py() or "", channel)
        if found:
            rows.append(i)
            texts.append(" ".join(found))
    if rows:
        more, extra = _terms(Words(pa.array(texts)))
        row = np.concatenate([row, np.array(rows)[more]])
        term = np.concatenate([term, extra])
    return row, term


@dataclass
class Evidence:
    """Sorted term hashes and a weight per term."""

    terms: np.ndarray
    weights: np.ndarray

    def features(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """Per row: its ``BEST`` strongest weights, and log(1 + terms with evidence)."""
        out = np.zeros((rows, BEST + 1))
        if not len(self.terms) or not len(term):
            return out
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == term)
        pair = np.unique(row[hit] * len(self.terms) + at[hit])
        row, weight = pair // len(self.terms), self.weights[pair % len(self.terms)]
        order = np.lexsort((-weight, row))
        row, weight = row[order], weight[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row, "left")
        top = nth < BEST
        out[row[top], nth[top]] = weight[top]
        out[:, BEST] = np.log1p(np.bincount(row, minlength=rows))
        return out


def _weigh(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
    """Lower confidence bound of the log odds of terms in ``a`` toxic and ``b`` clean documents."""
    odds = np.log((a + 0.5) / (n_a + 1.0)) - np.log((b + 0.5) / (n_b + 1.0))
    return odds - np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))


@dataclass
class ToxicityModel:
    grams: np.ndarray
    counts: np.ndarray
    evidence: Evidence
    coefficients: np.ndarray

    def scorer(self):
        channel = Channel(self.grams, self.counts)

        def score(batch: pa.RecordBatch, text: str) -> np.ndarray:
            row, term = text_terms(batch, text, channel)
            x = self.evidence.features(row, term, batch.num_rows)
            return lab.sigmoid(self.coefficients[0] + x @ self.coefficients[1:])

        return score


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None, doc_id: str = "doc_id",
    text: str = "text", rows: int = lab.SAMPLE_ROWS,
) -> ToxicityModel:
    """Character model from all documents, evidence and score from at most ``rows`` labelled ones.

    The score is fitted on evidence from the other half of the sample, so rare terms do not look
    better than they are. Without labels of both kinds every text scores the share of label 1, or 0.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    model = count_trigrams(docs, text).toPandas().sort_values("gram")
    grams, counts = model["gram"].to_numpy(np.int64), model["n"].to_numpy(np.int64)
    learn = F.lit(True) if learn is None else learn
    chosen = scratch.write(lab.sample(docs, labels, label, learn, doc_id, text, rows), "sample")
    shared = spark.sparkContext.broadcast((grams, counts))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity")
        channel = Channel(*shared.value)
        for whole in batches:
            for batch in pieces(whole, "text"):
                row, term = text_terms(batch, "text", channel)
                kind = (batch.column(2).to_numpy() + 2 * batch.column(3).to_numpy()).astype(np.int64)
                seen = np.unique(np.rec.fromarrays([row, term], names="r,t"))
                found, n = np.unique(np.rec.fromarrays([kind[seen.r], seen.t], names="k,t"), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(found.t)), pa.array(np.array(found.k)), pa.array(n)], names=["term", "kind", "n"])

    sizes = {(r["label"], r["half"]): r["n"] for r in chosen.groupBy("label", "half").agg(F.count("*").alias("n")).collect()}
    n = {(t, h): sizes.get((t, h), 0) for t in (0, 1) for h in (0, 1)}
    toxic, clean = n[1, 0] + n[1, 1], n[0, 0] + n[0, 1]
    none = Evidence(np.zeros(0, np.int64), np.zeros(0))
    if not toxic or not clean:
        share = toxic / max(1, toxic + clean)
        bias = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return ToxicityModel(grams, counts, none, np.array([bias] + [0.0] * (BEST + 1)))
    times = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)]
    # a term with evidence is in SUPPORT toxic documents and much more often there than elsewhere
    useful = (F.col("n1") + F.col("n3") >= SUPPORT) & (
        (F.col("n1") + F.col("n3")) / F.lit(float(toxic)) > 1.5 * (F.col("n0") + F.col("n2")) / F.lit(float(clean)))
    table = chosen.select("doc_id", "text", "label", "half").mapInArrow(count, "term bigint, kind bigint, n bigint").groupBy(
        "term").agg(*times).where(useful).toPandas().sort_values("term")
    c = table[["n0", "n1", "n2", "n3"]].to_numpy(np.float64)
    terms = table["term"].to_numpy(np.int64)

    def evidence(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> Evidence:
        weight = _weigh(a, b, n_a, n_b)
        keep = (weight > LEAST) & (a >= 1)
        return Evidence(terms[keep], weight[keep])

    halves = [evidence(c[:, 1], c[:, 0], n[1, 0], n[0, 0]), evidence(c[:, 3], c[:, 2], n[1, 1], n[0, 1])]
    whole = evidence(c[:, 1] + c[:, 3], c[:, 0] + c[:, 2], toxic, clean)
    given = spark.sparkContext.broadcast(halves)

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity")
        channel = Channel(*shared.value)
        for full in batches:
            for batch in pieces(full, "text"):
                row, term = text_terms(batch, "text", channel)
                half = batch.column(3).to_numpy()
                x = [given.value[1 - h].features(row, term, batch.num_rows) for h in (0, 1)]
                x = np.where(half[:, None] == 0, x[0], x[1])
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x[:, k]) for k in range(BEST + 1)], batch.column(2)],
                    names=[*[f"x{k}" for k in range(BEST + 1)], "label"])

    schema = ", ".join(f"x{k} double" for k in range(BEST + 1)) + ", label int"
    fit = chosen.mapInArrow(crossed, schema).toPandas()
    w = lab.logistic(fit.drop(columns="label").to_numpy(), fit["label"].to_numpy(np.float64))
    return ToxicityModel(grams, counts, whole, w)


def score_toxicity(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row; null and empty texts hold no evidence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity")
        score = shared.value.scorer()
        for whole in batches:
            for batch in pieces(whole, "text"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(score(batch, "text"))], names=["doc_id", "score"])

    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(run, f"doc_id {kind}, score double")


def remove_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity")
        score = shared.value.scorer()
        for whole in batches:
            for batch in pieces(whole, text):
                yield batch.filter(pa.array(score(batch, text) < limit))

    return docs.mapInArrow(run, docs.schema)
