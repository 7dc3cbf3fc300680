"""Archives, tokens, mixing, decontamination and codecs against plain code, and hard cases."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayplan.llm import fair_mix, separators, simple8b, suffix, warc
from dayplan.llm.shared import Words, pieces
from dayplan.llm.tokens import Encoder, encoder
from tests.llm.helpers import empty_docs, hard_docs, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_words_of_arrow_columns():
    texts = [None, "", "Ab-cd é1", "ab", "ÀB!", "  ", "x" * 10, "ab", "é"]
    column = pa.array(["skip", *texts]).slice(1)
    found = Words(column)
    assert [found.text(i) for i in range(len(found))] == [w for t in texts for w in plain_words(t)]
    assert found.counts().tolist() == [len(plain_words(t)) for t in texts]
    by_text = {}
    for i in range(len(found)):
        assert by_text.setdefault(found.text(i), found.hash[i]) == found.hash[i]
    assert len(set(by_text.values())) == len(by_text)


def test_pieces_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"t": ["a" * n for n in (5, 50, 0, 1, 9, 100)] + [None]})
    cut = list(pieces(batch, "t", 20))
    assert pa.Table.from_batches(cut).equals(pa.Table.from_batches([batch]))
    assert all(c.num_rows == 1 or sum(len(t or "") for t in c["t"].to_pylist()) <= 20 for c in cut)


# archives

PAGE = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def plain_revisits(rows):
    best = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and page is not None:
            best[body] = max(best.get(body, page), page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        top = best.get(body) if len(body) >= 1000 else None
        again = top is not None and page != top
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(map(repr, out))


def test_archives_round_trip(spark):
    big, record = "é" * 700, "WARC/1.1\r\nWARC-Type: response\r\n"
    rows = [
        (1, "u", big), (2, None, big), (3, "u\r\nX: y", big), (3, "u", big), (4, "u", "s" * 999), (5, "u", "s" * 999),
        (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", "x" * 1000 + "\r\n"), (9, "u", "x" * 1000 + "\r\n\r\n"),
        (10, "u", "x" * 1000 + "\r\n\r\n" + record + "Content-Length: 3\r\n\r\nabc\r\n\r\n"), (11, "u", "\r\n\r\n" * 400),
        (12, "u", "\r\n\r\n" * 400), (None, None, "n" * 1200), (None, None, "n" * 1200), (13, "u", "﻿x"), (-4, "u", big),
    ]
    df = spark.createDataFrame(rows, PAGE).withColumn("digest", F.lit("clash")).withColumn("bytes", F.lit(0)).repartition(3)
    got = warc.archive_round_trip(df)
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain_revisits(rows)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_archives_without_compression_and_mark(spark, tmp_path):
    rows = [(i, "u", f"<p>{'z' * 1000}</p>") for i in range(50)]
    path = f"{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame(rows, PAGE).repartition(4), path, compression="none")
    found = warc.read_archives(spark, path)
    assert found.count() == 50
    assert {r["payload"] for r in found.where("record_type = 'response'").collect()} == {rows[0][2]}
    assert found.where("record_type = 'revisit' and payload = '' and refers_to = 49").count() == 49
    assert open(next(tmp_path.glob("warc/part-*")), "rb").read().startswith(b"WARC/1.1\r\n")


# tokens

def test_ids_equal_the_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b <|endoftext|><|endoftext|>", "<|endoftext|", "", None, " ", "  ", "a", " a", "a  b", "a \n b\n\n  c ", "don't we'll I'D", "x²½ y\x1c \x85z\xa0", "日本　語 x", "1234 5,6",
             "<|endoftext|> z", "é" * 300, words(500, 1), "\t\t\n", "a_b __c__", "٣٤ ٥", "🙂 🙂🙂", "x​ y"]
    got = encoder().ids(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u2").tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)
    plain.encode_special_tokens = True  # what the separator scan wants: only the ends of documents are end ids
    for text, ids in zip(texts, Encoder(public_tokenizers.path("byte_bpe_50k.json"), added=False).ids(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_other_vocabularies_are_refused(tmp_path):
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as source:
        parts = json.load(source)
    parts["normalizer"] = {"type": "Lowercase"}
    path = tmp_path / "lower.json"
    path.write_text(json.dumps(parts))
    with pytest.raises(ValueError):
        Encoder(str(path))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", *"ab1 \n\t'!é²\x1c\xa0日<|"]), max_size=30).map("".join))
def test_ids_equal_the_tokenizers_on_any_text(text):
    coder = encoder()
    assert np.frombuffer(coder.ids([text])[0], "<u2").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_small_cache_gives_the_same_ids():
    import public_tokenizers

    small = Encoder(public_tokenizers.path("byte_bpe_50k.json"), cache_pieces=5)
    texts = [words(50, k) for k in range(6)]
    assert [small.ids([t])[0] for t in texts] == encoder().ids(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=400),
       st.sampled_from([1, 7, 128]))
def test_simple8b_round_trip(values, block):
    ids = np.array(values, np.uint64)
    coded, used = simple8b.encode(ids, block)
    offsets = np.concatenate([[0], np.cumsum(used)]).astype(np.int64)
    assert simple8b.decode(coded, offsets, len(ids), block).tolist() == values
    for k in range(len(used)):  # any block on its own
        part = ids[k * block : (k + 1) * block]
        own = simple8b.decode(coded[offsets[k] : offsets[k + 1]], np.array([0, used[k]]), len(part), block)
        assert own.tolist() == part.tolist()


def test_simple8b_files_in_order(spark):
    docs = hard_docs(spark).repartition(5)
    got = simple8b.token_round_trip(docs).orderBy("start").collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    ends = 0
    for r in got:
        assert r["start"] == ends
        ends += r["n_tokens"]
    want = []
    for r in rows:
        x = np.frombuffer(encoder().ids([r["text"]])[0], "<u2").tolist() + [0]
        want.append((r["doc_id"], len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in got)
    assert simple8b.token_round_trip(empty_docs(spark)).count() == 0


def test_separator_scan_counts(spark):
    docs = hard_docs(spark).repartition(3)
    got = separators.token_counts(docs).collect()
    want = [(r["doc_id"], len(encoder(added=False).ids([r["text"]])[0]) // 2) for r in docs.collect()]
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["n_tokens"])) for r in got)
    assert separators.token_counts(empty_docs(spark)).count() == 0


def test_separator_scan_stitches_blocks(spark, tmp_path):
    rng = np.random.default_rng(3)
    files = {"a.bin": rng.integers(0, 3, 997), "b.bin": np.full(50, 1), "c.bin": np.array([], int), "d.bin": np.array([0, 0, 0]),
             "e.bin": np.concatenate([np.full(64, 2), [0], np.full(200, 2), [0]])}
    want = []
    for name, ids in files.items():
        (tmp_path / name).write_bytes(ids.astype("<u2").tobytes())
        start = 0
        for end in np.flatnonzero(ids == 0).tolist():
            want.append((name, start, end - start, True))
            start = end + 1
        if start < len(ids):
            want.append((name, start, len(ids) - start, False))
    names = spark.createDataFrame([(n,) for n in [*files, "a.bin"]], "name string")
    got = separators.scan_files(names, str(tmp_path), end_id=0, block_ids=16).orderBy("name", "row").collect()
    assert [(r["name"], r["start"], r["n_tokens"], r["closed"]) for r in got] == want
    assert [r["row"] for r in got if r["name"] == "a.bin"] == list(range(sum(w[0] == "a.bin" for w in want)))


# mixing

def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(3.0 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if 3.0 * sizes[s] <= weight[s] * level}
        if not more:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= more


def test_mix_meets_targets(spark):
    rows = []
    for n, (source, count) in enumerate([("a", 400), ("b", 30), ("c", 3), (None, 50), ("Z", 120), ("é", 60)]):
        rows += [(1000 * n + k, words(k % 7 + 1, k), source) for k in range(count)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = fair_mix.fair_mix(docs).collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = plain_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    assert sum(taken.values()) == sum(sizes.values())
    assert all(abs(taken[s] - want[s]) <= 7 for s in sizes)
    again = fair_mix.fair_mix(docs.repartition(2)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    mixed = fair_mix.mixed_rows(docs)
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: -(-r["taken"] // r["size"]) for r in got if r["taken"]}


def test_mix_hard_cases(spark):
    docs = hard_docs(spark)
    got = fair_mix.fair_mix(docs).collect()
    assert len(got) == docs.count()
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert sum(r["taken"] for r in got) == sum(r["size"] for r in got)
    mixed = fair_mix.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(-(-r["taken"] // r["size"]) for r in got if r["taken"])
    assert fair_mix.fair_mix(empty_docs(spark)).count() == 0 and fair_mix.mixed_rows(empty_docs(spark)).count() == 0
    none = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in fair_mix.fair_mix(none).collect()] == [0, 0]


# decontamination

def plain_hits(text, items, window=10):
    doc, hit, found = plain_words(text), set(), set()
    for name, body in items:
        item = plain_words(body)
        k = min(window, len(item))
        grams = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)} if k else set()
        for i in range(len(doc) - k + 1 if k else 0):
            if tuple(doc[i : i + k]) in grams:
                hit.update(range(i, i + k))
                found.add(str(name))
    return len(doc), len(hit), sorted(found)


def longest_match(text, items):
    doc, best = plain_words(text), 0
    for _, body in items:
        item = plain_words(body)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]:
                    n += 1
                if n >= min(10, len(item)):
                    best = max(best, n)
    return best


def contaminated_case():
    items = [(1, words(30, 1, 20)), (2, words(12, 2, 20)), (3, "Short Item Here"), (4, ""), (5, None), (6, words(30, 1, 20)),
             (10, "a a a a a a a a a a a a"), (None, "left out item that has ten words or even more of them")]
    clean = words(50, 9, 20)
    texts = [
        clean, None, "", items[0][1], clean + " " + items[1][1] + " " + clean, "x " + "a " * 40, "short, ITEM... here!",
        items[0][1][20:100], " ".join(items[0][1].split()[:9]), (items[1][1] + " ") * 3, "a " * 9, words(2000, 5, 6) + " short item here",
        items[7][1], "é " + items[0][1].upper(),
    ]
    return items, texts


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_suffix_arrays_find_all_windows(spark, monkeypatch, block_bytes):
    items, texts = contaminated_case()
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(suffix.store_tests, "__defaults__", (block_bytes,))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("clash"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("found", F.lit(1)).repartition(3)
    got = {r["doc_id"]: r["_found"] for r in suffix.find_contamination(docs, bench).collect()}
    known = [i for i in items if i[0] is not None]
    for n, text in enumerate(texts):
        count, hit, found = plain_hits(text, known)
        assert (got[n]["n_words"], got[n]["n_hit"], got[n]["items"]) == (count, hit, found), n
        if n < 8:
            assert got[n]["longest"] == longest_match(text, known), n
        for m in got[n]["matches"]:
            body = dict((str(k), plain_words(v)) for k, v in known)[m["item"]]
            run = plain_words(text)[m["first"] : m["first"] + m["words"]]
            assert any(body[i : i + len(run)] == run for i in range(len(body)))
    clean = suffix.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [n for n, t in enumerate(texts) if not plain_hits(t, known)[1]]


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(1)
    for _ in range(30):
        tokens = np.concatenate([np.append(rng.integers(0, 3, rng.integers(1, 30)), -1) for _ in range(rng.integers(1, 8))])
        order = suffix.suffix_order(tokens, 16)
        seen = [tuple(tokens[i : i + 16][: list(tokens[i:]).index(-1)]) for i in order]
        assert seen == sorted(seen) and sorted(order) == np.flatnonzero(tokens >= 0).tolist()


def test_decontamination_hard_cases(spark):
    docs, bench = hard_docs(spark), spark.createDataFrame([(1, words(60, 1))], "item_id long, text string")
    left = suffix.remove_contaminated(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in left.collect()} == {1, 2, 3}
    assert suffix.remove_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert suffix.remove_contaminated(empty_docs(spark), bench).count() == 0


def test_repeats_on_both_sides_do_not_multiply():
    import time

    items = [str(k) for k in range(50)]
    block = suffix.encode_tests(items, pa.array(["la " * 200] * 50))
    words_ = Words(pa.array(["la " * 20_000, "b " + "la " * 12 + "c", "la " * 9]))
    hits = suffix.Hits(np.zeros(len(words_), bool), [set() for _ in range(3)], np.zeros(3, np.int64), [[] for _ in range(3)])
    begin = time.time()
    suffix.search(words_, block, hits)
    assert time.time() - begin < 30
    assert hits.items == [set(items), set(items), set()] and hits.longest.tolist() == [200, 12, 0]
    assert hits.hit.sum() == 20_012 and hits.matches[1] == [(1, 12, "0")]


def test_one_passage_in_many_items_and_places():
    body = words(400, 3, 100_000)
    block = suffix.encode_tests([f"i{k}" for k in range(40)], pa.array([body] * 40))
    texts = [f"{words(30, 50 + k)} {body} {words(30, 90 + k)}" for k in range(200)]
    w = Words(pa.array(texts))
    hits = suffix.Hits(np.zeros(len(w), bool), [set() for _ in texts], np.zeros(200, np.int64), [[] for _ in texts])
    suffix.search(w, block, hits)
    assert all(len(i) == 40 for i in hits.items) and set(hits.longest) == {400}
    assert hits.hit.sum() == 200 * 400 and all(m == [(30, 400, "i0")] for m in hits.matches)
