"""Similarity join, neighbours and components against brute force, and hard cases."""

import itertools
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from dayplan.llm import chosen_path as cp
from dayplan.llm import neighbours
from dayplan.llm.components import components
from dayplan.llm.shared import Scratch, Words, bit_filter, in_filter
from tests.llm.helpers import empty_docs, hard_docs, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_set(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def plain_classes(rows):
    """Per row: least id of its class, links to other rows, different linked sets."""
    sets = [plain_set(t) for _, t in rows]
    near = [[i != j and bool(a) and bool(b) and len(a & b) / len(a | b) >= 0.8 for j, b in enumerate(sets)]
            for i, a in enumerate(sets)]
    label = list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.product(range(len(rows)), repeat=2):
            if near[i][j]:
                label[i] = label[j] = min(label[i], label[j])
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((doc, min(ids) if ids else None, sum(near[i]), len({sets[j] for j in range(len(rows)) if near[i][j]} - {sets[i]})))
    return out


def edited(text, places, tag):
    w = text.split()
    for p in places:
        w[p] = tag
    return " ".join(w)


def near_rows():
    rows, n = [], 0
    for group in range(12):
        base = words(120 + 10 * group, group, 5000)
        for copy in range(group % 5 + 1):
            rows.append((n, edited(base, [11 * copy + 3], f"e{copy}") if copy else base))
            n += 1
    rows += [(n + k, words(50, 900 + k, 5000)) for k in range(20)]
    n += 20
    rows += [(n, rows[3][1].upper()), (n + 1, rows[3][1]), (n + 2, "a b c"), (n + 3, "A, b C!"), (n + 4, "a b c d e"), (n + 5, "")]
    base = words(45, 77, 5000)  # one edit leaves exactly or about 0.8
    return rows + [(n + 10 + p, edited(base, [p], "odd")) for p in range(5)] + [(n + 20, base)]


def test_shingles_and_keys():
    texts = ["a b c d e f", "x", None, "a b c d e f a b c d e f", "A b-c d e f", "a b"]
    tokens, sizes = cp.shingles(Words(pa.array(texts)))
    assert sizes.tolist() == [len(plain_set(t)) for t in texts]
    k1, k2 = cp.set_keys(tokens, sizes)
    assert k1[0] == k1[4] and k2[0] == k2[4] and k1[2] == 0 and len({*k1.tolist()}) == 5


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))
    b = np.unique(np.concatenate([a[:800], rng.integers(0, 2**63, 100).astype(np.uint64)]))
    s = cp.sketches(np.concatenate([a, b]), np.array([len(a), len(b)]), 512)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.07


def test_one_run_keeps_pairs_as_often_as_said():
    rng = np.random.default_rng(4)
    kept, runs = 0, 3000
    for r in range(runs):
        same = rng.random(64) < 0.8
        a = rng.integers(0, 2**32, (1, 64), dtype=np.uint64).astype(np.uint32)
        both = np.vstack([a, np.where(same, a, a + np.uint32(1))])
        nodes = [np.array([r, r], np.uint64)]
        for _ in range(3):
            fresh = []
            for node in nodes:
                row, child = cp.children(node, both)
                shared = set(child[row == 0].tolist()) & set(child[row == 1].tolist())
                fresh += [np.array([c, c], np.uint64) for c in shared]
            nodes = fresh
        kept += bool(nodes)
    assert abs(kept / runs - cp.kept_in_a_run(0.8, 3)) < 0.03
    assert cp.runs_for(0.999, 0.8, 4) >= cp.runs_for(0.9, 0.8, 4) > 1


def check(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1)).withColumn("root", F.lit(2))
    got = cp.similar_documents(df.repartition(4), **settings).collect()
    want = plain_classes(rows)
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["class_id"], r["n_links"], r["n_text_links"])) for r in got)


def test_join_equals_brute_force(spark):
    check(spark, near_rows())


def test_join_with_small_leaves_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(cp, "BLOCK", 3)
    monkeypatch.setattr(cp, "GROUP_TOKENS", 500)
    check(spark, near_rows(), leaf=2)


def test_join_hard_cases(spark):
    rows = [(r["doc_id"], r["text"]) for r in hard_docs(spark).collect()]
    check(spark, rows)
    docs = hard_docs(spark)
    kept = cp.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 4, 5, 6, 7, 9, 11, 12, 13, 13, None, None], key=str)
    assert cp.similar_documents(empty_docs(spark)).count() == 0 and cp.keep_one_of_each(empty_docs(spark)).count() == 0


def test_all_rows_equal(spark):
    rows = [(k % 7, words(30, 1)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = cp.similar_documents(df).collect()
    assert {(r["class_id"], r["n_links"], r["n_text_links"]) for r in got} == {(0, 299, 0)}
    assert [r["doc_id"] for r in cp.keep_one_of_each(df).collect()] == [0]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (200, 201), (201, 200), (300, 299)]
    got = {r["id"]: r["root"] for r in components(
        spark.createDataFrame(edges, "a long, b long").repartition(5), Scratch(spark, "t")).collect()}
    want = {i: 0 for i in range(1, 41)} | {100 + k: 100 for k in range(1, 60)} | {201: 200, 300: 299}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def test_bit_filter(spark):
    rng = np.random.default_rng(1)
    inside = rng.integers(-(2**63), 2**63 - 1, 500)
    bits = bit_filter(spark.createDataFrame(pd.DataFrame({"h": inside})))
    assert in_filter(bits, inside).all() and in_filter(bits, rng.integers(-(2**63), 2**63 - 1, 5000)).mean() < 0.01
    assert not in_filter(bit_filter(spark.createDataFrame([], "h long")), inside).any()


# neighbours

def plain_nearest(rows, queries, top=5):
    def sound(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    best = {}
    for i, v in rows:
        if i is not None and sound(v):
            best[i] = min(best.get(i, tuple(v)), tuple(v))
    out = {}
    for q in sorted(i for i in best if queries(i)):
        a = np.array(best[q], float)
        score = sorted(
            (-round(float(a @ np.array(v, float) / np.linalg.norm(a) / np.linalg.norm(v)), 9), i)
            for i, v in best.items() if i != q and len(v) == len(a))
        out[q] = [(i, -s) for s, i in score[:top]]
    return out


def test_recall_on_random_vectors(spark):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(20, 32))
    rows = [(i, (centre[i % 20] + rng.normal(size=32)).astype(np.float32).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    want = plain_nearest(rows, lambda i: i % 50 == 0)
    assert got.keys() == want.keys() and all([x[2] for x in v] == [1, 2, 3, 4, 5] for v in got.values())
    recall = np.mean([len({x[0] for x in got[q]} & {x[0] for x in want[q]}) / 5 for q in want])
    assert recall >= 0.9
    for q, found in got.items():
        a = np.array(rows[q][1], float)
        for i, score, _ in found:
            b = np.array(rows[i][1], float)
            assert abs(score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_perturbations_come_by_cost():
    off = np.random.default_rng(3).random((20, 6))
    every = np.array(list(itertools.product((0, -1, 1), repeat=6)))
    cost = (off[:, None, :] ** 2 * (every == -1) + (1 - off[:, None, :]) ** 2 * (every == 1)).sum(2)
    for probes in (1, 40, 729, 5000):
        moves = neighbours._moves(off, probes)
        assert moves.shape == (20, min(probes, 729), 6)
        own = (off[:, None, :] ** 2 * (moves == -1) + (1 - off[:, None, :]) ** 2 * (moves == 1)).sum(2)
        assert np.allclose(own, np.sort(cost, axis=1)[:, :probes])
        assert all(len({tuple(m) for m in row}) == len(row) for row in moves)


def test_sizes_follow_the_rows():
    assert neighbours.sizes(0) == neighbours.sizes(1000) == neighbours.sizes(16_000) == (8, 300)
    assert neighbours.sizes(64 * 2**10)[0] == 10 and neighbours.sizes(64 * 2**20)[0] == 20
    shares = [probes / 2**hashes for hashes, probes in map(neighbours.sizes, (2**14, 2**17, 2**20, 2**27))]
    assert shares == sorted(shares, reverse=True) and shares[-1] < shares[0] / 10


def test_recall_holds_with_more_hashes(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(6000, 24)).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = plain_nearest(rows, lambda i: i % 300 == 0)
    for rows_as_if in (1_000, 250_000):
        hashes, probes = neighbours.sizes(rows_as_if)
        got = {}
        for r in neighbours.nearest(df, F.col("vec_id") % 300 == 0, hashes=hashes, probes=probes).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_neighbours_hard_cases(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP_ROWS", 7)  # cuts the bucket of copies into parts
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(40)] + [
        (50, None), (100, [0.0, 0.0, 0.0]), (150, [1.0, None, 2.0]), (200, [float("nan"), 1.0, 1.0]), (250, [float("inf"), 1.0, 0.0]),
        (300, []), (None, same), (350, [-1.0, -2.0, -3.0]), (400, [1.0, 0.0]), (450, [0.0, 1.0]), (500, [2.0, 4.0, 6.0]), (0, same), (550, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(3)).withColumn("key", F.lit("k"))
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    want = {q: v for q, v in plain_nearest(rows, lambda i: i % 50 == 0).items() if v}
    assert got == want
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours_of_huge_and_tiny_vectors(spark):
    rng = np.random.default_rng(8)
    unit = rng.normal(size=(60, 6))
    rows = [(k, [float(x) for x in unit[k] * (1e200 if k % 3 == 0 else 1e-200 if k % 3 == 1 else 1.0)]) for k in range(60)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0).collect()
    cosine = unit @ unit.T / np.linalg.norm(unit, axis=1)[:, None] / np.linalg.norm(unit, axis=1)[None, :]
    for q in range(0, 60, 10):
        order = sorted((k for k in range(60) if k != q), key=lambda k: -cosine[q, k])[:5]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert len(mine) == 5 and all(abs(r["score"] - cosine[q, r["vec_id"]]) < 1e-12 for r in mine)
        assert len({r["vec_id"] for r in mine} & set(order)) >= 4
