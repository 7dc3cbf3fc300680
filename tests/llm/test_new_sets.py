"""Threshold negatives, prefix tries and wrapped secrets against brute force, and hard cases."""

import base64
import bz2
import gzip
import hashlib
import lzma
import math
import random
import re
import urllib.parse
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayplan.llm import hard_negatives as hn
from dayplan.llm import prefix_trie as pt
from dayplan.llm import secret_scan as ss
from dayplan.llm.hot import join_facts
from dayplan.llm.shared import Scratch
from tests.llm.helpers import empty_docs, hard_docs

# negatives

VECTORS = "vec_id long, embedding array<float>, label int, score string, name string"


def plain_negatives(rows, anchors, positives=5, negatives=10, least=30, most=90):
    kept = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        kept[vec_id] = min(kept.get(vec_id, q), q)
    out = []
    for a in [k for k in kept if anchors(k)]:
        def score(b):
            return sum(x * y for x, y in zip(kept[a][1], kept[b][1]))

        order = sorted((b for b in kept if b != a), key=lambda b: (-score(b), b))
        for p in [b for b in order if kept[b][0] == kept[a][0]][:positives]:
            fine = [b for b in order if kept[b][0] != kept[a][0] and least * score(p) <= 100 * score(b) <= most * score(p)]
            out += [(a, p, rank, b, score(p), score(b)) for rank, b in enumerate(fine[:negatives], 1)]
    return sorted(out)


def vector_rows(n, dim, labels, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(int(k), [float(x) for x in np.float32(rng.normal(size=dim) * spread)], int(rng.integers(labels)), "x", "y") for k in range(n)]


@pytest.mark.parametrize("shard", [7, 64, 8192])
def test_negatives_equal_brute_force(spark, shard):
    rows = vector_rows(240, 6, 4, shard)
    rows += [(500 + k, rows[0][1], k % 3, "x", "y") for k in range(30)]  # ties
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = hn.mine_negatives(df, F.col("vec_id") % 10 == 0, shard_rows=shard)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda k: k % 10 == 0)


def test_negatives_hard_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = vector_rows(60, 4, 2, 3) + [
        (None, [1.0, 1.0, 1.0, 1.0], 1, "x", "y"), (100, None, 1, "x", "y"), (101, [1.0, None, 0.0, 0.0], 1, "x", "y"),
        (102, [nan, 0.0, 0.0, 0.0], 0, "x", "y"), (103, [inf, 0.0, 0.0, 0.0], 0, "x", "y"), (104, [1.0] * 4, None, "x", "y"),
        (110, [], 0, "x", "y"), (120, [0.0] * 4, 1, "x", "y"), (130, [2.0, 1.0], 1, "x", "y"), (5, [9.0] * 4, 1, "x", "y"),
        (10, vector_rows(60, 4, 2, 3)[10][1], 1, "x", "y")]
    got = hn.mine_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0, shard_rows=16)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda k: k % 10 == 0)
    none = spark.createDataFrame([], VECTORS)
    assert hn.mine_negatives(none, F.lit(True)).count() == 0
    assert hn.mine_negatives(spark.createDataFrame(rows, VECTORS), F.lit(False)).count() == 0
    huge = [(k, [1e30 if k == 3 else float(k), 1.0], k % 2, "x", "y") for k in range(12)]
    got = hn.mine_negatives(spark.createDataFrame(huge, VECTORS), F.lit(True))
    assert sorted(map(tuple, got.collect())) == plain_negatives([r for r in huge if r[0] != 3], lambda k: True)


def test_large_components_are_exact(spark):
    rows = [(k, [float(2**21 + 3 * k), float(-(2**21) + k), 0.5], k % 2, "x", "y") for k in range(30)]
    got = hn.mine_negatives(spark.createDataFrame(rows, VECTORS), F.lit(True), least=0, most=100)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda k: True, least=0, most=100)


def test_threshold_stops_early():
    import pandas as pd

    rng = np.random.default_rng(1)
    vectors = rng.integers(-100, 100, (5000, 3))
    vectors[17] = (900, 900, 900)
    vectors[18] = (800, 900, 900)
    frame = pd.DataFrame({"vec_id": np.arange(5000), "label": 0, "vec": list(vectors)})
    shard = hn.Shard.build(frame, 3)
    found = hn.Windows([(hn.WHOLE.min, hn.WHOLE.max)], 2)
    scored = hn.search(shard, np.array([1, 1, 1]), np.ones(5000, bool), found)
    assert found.ids[0].tolist() == [17, 18] and scored < 100


# tries

TURNS = "conv_id long, turn long, role string, text string, a string, p string, depth string, n string"


def plain_trie(rows):
    said = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            said.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in said.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()))
    built = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = [t[1:] for t in said.get(base, [])[:h]] + [t[1:] for t in said[c][h:]]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)

    def words(text):
        return len(re.findall(r"[^\x20\x09-\x0D]+", text))

    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(m) == len(node) + 1 for m in below),
            sum(not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in members) for m in below),
            sum((len(members[m]) - 1) * words(m[-1][1]) for m in below if m),
            hashlib.sha256(",".join(map(str, sorted(c for c in convs if len(built[c]) == len(node)))).encode()).hexdigest()))
    return sorted(out, key=repr)


def turn_rows(seed, n=70):
    rng = random.Random(seed)
    rows = []
    for conv in range(-5, n):
        for turn in range(rng.choice((1, 1, 2, 3, 5))):
            rows.append((conv, turn, rng.choice(("user", "user", None)), rng.choice(("a b", "a b", "c", None, "")), *"xxxx"))
    rows += [(7, None, "user", "first of all", *"xxxx"), (7, 2, "user", "tie", *"xxxx"), (7, 2, "user", "tie", *"xxxx"),
             (7, 2, "bot", "tie", *"xxxx"), (None, 1, "user", "nobody", *"xxxx")]
    return [r for r in rows if r[0] != 40]  # a group without its first conversation


@pytest.mark.parametrize("block", [2, 3, 1024])
def test_trie_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pt, "BLOCK", block)
    monkeypatch.setattr(pt, "CHUNK", 3)
    rows = turn_rows(block)
    got = pt.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(6))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(rows)


def test_trie_of_long_and_equal_conversations(spark):
    rows = [(c, t, "user", f"turn {t}", *"xxxx") for c in range(1, 8) for t in range(30)]
    rows += [(9, t, "user", f"turn {t % 2}", *"xxxx") for t in range(200)]
    got = pt.prefix_trie(spark.createDataFrame(rows, TURNS))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert pt.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_facts_join_hot_and_cold_keys(spark):
    scratch = Scratch(spark, "t")
    rows = scratch.write(spark.range(30_000).selectExpr("id", "if(id % 3 = 0, 0, id) as k"), "rows")
    facts = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("f", F.col("k") * 2)
    got = join_facts(rows, facts, ["k"], "n", 30_000)
    assert got.count() == 30_000 and got.where("f <> 2 * k or n <> if(k = 0, 10000, 1)").count() == 0


# secrets

SECRET_RULES = [
    (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     lambda m: len(m.group(2)) >= 8),
    (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16), (r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
]


def plain_secrets(text):
    return sorted(((m.start(), m.end(), k) for k, (rule, fine) in enumerate(SECRET_RULES) for m in re.finditer(rule, text) if fine(m)),
                  key=lambda s: (s[0], s[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "Secret", "api_key", "APIKEY", "tokeN", "toKen", "'", '"', " ", ":", "=", "AKIA", "AB12CD34", "é",
                                 "0123456789abcdef", "deadbeef", "f", "\n", "longenough", "x-y/z"]), max_size=12).map("".join))
def test_base_secrets_equal_the_rules(text):
    assert ss.base_secrets(text) == plain_secrets(text)


SECRET = 'api_key = "Zx81-Zx81-Zx81"'
WRAPS = {
    "url": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "urlsafe": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "lines": lambda s: base64.encodebytes((s + " " + "pad " * 40).encode()).decode(),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
    "bzip2": lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
    "xz": lambda s: base64.b64encode(lzma.compress(s.encode())).decode(),
    "raw": lambda s: "".join(f"\\x{b:02x}" for b in gzip.compress(s.encode())),
}


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from(sorted(WRAPS)), min_size=1, max_size=4))
def test_wrapped_secrets_are_found_where_they_stand(order):
    text = SECRET
    for name in order:
        text = WRAPS[name](text)
    whole = f"é before {text.strip()} after"
    base, more, cut = ss.all_secrets(whole)
    assert base == plain_secrets(whole) and not cut
    assert any(whole[a:b] in whole[9:-6] and 9 <= a < b <= len(whole) - 6 for a, b, k, _ in more if k == 0)


def test_spans_of_partly_escaped_secrets():
    text = "see password%3D\\u0068unter2hunter2 here"
    (a, b, kind, path), = ss.all_secrets(text)[1]
    assert text[a:b] == "password%3D\\u0068unter2hunter2" and kind == 0 and path.startswith("escape")
    assert ss.all_secrets("100%25 of " + "words " * 5)[1] == []


def test_escapes_against_the_library():
    for text in ("%41%C3%A9%2B", "a%20b", "x%2525y", "%e6%97%a5"):
        want = text
        for _ in range(9):
            want = urllib.parse.unquote(want)
        layer = ss.Layer(text, np.arange(len(text)), np.arange(len(text)) + 1, ())
        while (inner := ss.unescape(layer)) is not None:
            layer = inner
        assert layer.text == want


def test_cycles_bombs_and_depth_end():
    text = "token=abcdefgh1"
    for k in range(40):
        text = text.replace("=", "%3D") if k == 0 else text.replace("%", "\\u0025" if k % 2 else "%25")
    assert any(k == 0 for *_, k, _ in ss.all_secrets(text)[1])
    bomb = base64.b64encode(gzip.compress(b"0" * 50_000_000)).decode()
    assert ss.all_secrets(bomb)[2]
    for text in ("a" * 300_000, ("A" * 76 + "\n") * 5000, "%4" * 100_000, "\\u" * 100_000, "secret" + " " * 300_000, "%25" * 100_000 + "41"):
        ss.all_secrets(text)


def test_secret_hard_cases(spark):
    docs = hard_docs(spark)
    got = ss.find_secrets(docs)
    assert got.count() == docs.count() and got.where("size(found) > 0 or cut").count() == 0
    assert ss.find_secrets(empty_docs(spark)).count() == 0 and ss.redact_secrets(empty_docs(spark)).count() == 0
    assert ss.redact_secrets(docs).columns == docs.columns and ss.redact_secrets(docs).where("text is null").count() == 2
    rows = [(None, f"x {WRAPS['gzip'](SECRET)} y"), (1, SECRET), (1, SECRET)]
    clean = ss.redact_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["text"] for r in clean) == ['[SECRET]"', '[SECRET]"', "x [SECRET] y"]
