"""Toxicity, quality and personal data against plain code and held-out accuracy, and hard cases."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dayplan.llm import deobfuscate as de
from dayplan.llm import disclosure as di
from dayplan.llm import factorisation as fm
from dayplan.llm import labels as lab
from dayplan.llm.shared import Words
from tests.llm.helpers import empty_docs, hard_docs, words

COMMON = "the river house garden winter paper silver market window little people morning letter number yellow".split()


def labelled(spark, n=400, bad=("idiot", "scum", "moron"), low="$$$ ### &&&"):
    r = random.Random(1)
    docs, labels = [], []
    for k in range(n):
        body = [r.choice(COMMON) + r.choice(["", "", "s", "ed"]) for _ in range(r.randrange(5, 60))]
        toxic, poor = k % 5 == 0, k % 4 == 0
        if toxic:
            body.insert(r.randrange(len(body)), r.choice(bad))
        docs.append((k, " ".join(w + (r.choice(low.split()) if poor else "") for w in body), None, "s", None))
        if k % 10 != 9:
            labels.append((k, int(not poor), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


# toxicity

def plain_trigrams(texts):
    out = {}
    for text in texts:
        symbols = [0, 0, *[int(de._SYMBOL[b]) for b in (text or "").encode()], 0, 0]
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            key = (a * de.SYMBOLS + b) * de.SYMBOLS + c
            out[key] = out.get(key, 0) + 1
    return out


def test_trigrams_of_all_texts(spark):
    texts = ["abc Ab", "é z", None, "", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    got = {r["gram"]: r["n"] for r in de.count_trigrams(df, "text").collect()}
    want = plain_trigrams(t for t in texts if t)
    assert {k: v for k, v in got.items() if k} == {k: v for k, v in want.items() if k}  # 0 is all outside


def channel():
    grams = plain_trigrams([" ".join(["you are an idiot and a moron", "the worthless clown spilled stupid trash", *COMMON])] * 50)
    keys = np.array(sorted(grams))
    return de.Channel(keys, np.array([grams[k] for k in keys.tolist()]))


@pytest.mark.parametrize("written,meant", [
    ("1d10t", "idiot"), ("id!ot", "idiot"), ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("idiiiot", "idiot"), ("m0r0n", "moron"),
    ("m-0-r-o-n", "moron"), ("$tup1d", "stupid"), ("cl0wn", "clown"), ("trraaash", "trash"), ("idiot", "idiot"),
])
def test_disguised_words_are_restored(written, meant):
    assert set(de.restored_words(written, channel())) == ({meant} - {written}) and channel().restore(written) == meant
    column = pa.array(["clean text only", f"so {written} here", None, ""])
    data, ends = de.text_bytes(column)
    assert written == meant or de.suspicious(data, ends).tolist() == [1]


def test_viterbi_is_the_cheapest_path():
    model = channel()

    def cost(word):
        symbols, total = [0, 0], 0.0
        for b in word.encode():
            total += model.cost(symbols[-2], symbols[-1], int(de._SYMBOL[b]))
            symbols.append(int(de._SYMBOL[b]))
        return total + model.cost(symbols[-2], symbols[-1], 0)

    best = min(((cost(a + "d" + b + c + "t"), a + "d" + b + c + "t") for a in "il" for b in "il" for c in "o"), key=lambda x: x)
    assert model.restore("1d10t") == best[1]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = de.fit_toxicity(docs, labels, learn=lab.fold("doc_id", 5) != 0)
    got = {r["doc_id"]: r["score"] for r in de.score_toxicity(docs, model).collect()}
    assert len(got) == 400 and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[k] >= 0.5) == (k % 5 == 0) for k in got]) > 0.98
    again = de.fit_toxicity(docs.repartition(7), labels, learn=lab.fold("doc_id", 5) != 0)
    assert np.allclose(again.coefficients, model.coefficients)
    hidden = spark.createDataFrame([(1, "the river 1d10t house garden"), (2, "the river house garden"), (3, "w1nter s c u m river")],
                                   "doc_id long, text string")
    found = {r["doc_id"]: r["score"] >= 0.5 for r in de.score_toxicity(hidden, model).collect()}
    assert found == {1: True, 2: False, 3: True}


def test_toxicity_hard_cases(spark):
    docs, labels = labelled(spark, 60)
    model = de.fit_toxicity(docs, labels)
    hard = hard_docs(spark)
    assert de.score_toxicity(hard, model).where("score >= 0 and score <= 1").count() == hard.count()
    left = de.remove_toxic(hard, model)
    assert left.columns == hard.columns and left.count() == hard.count()
    assert de.score_toxicity(empty_docs(spark), model).count() == 0 and de.remove_toxic(empty_docs(spark), model).count() == 0
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.selectExpr("doc_id", "cast(null as int) as toxic")):
        none = de.fit_toxicity(docs, some)
        assert de.score_toxicity(docs, none).where("score < 0.01").count() == 60
    assert de.score_toxicity(docs, de.fit_toxicity(empty_docs(spark), labels)).where("score < 0.01").count() == 60


def test_samples_are_bounded_and_fold_wise(spark):
    docs, labels = labelled(spark, 100)
    both = labels.unionAll(labels.selectExpr("doc_id", "1 - quality", "1 - toxic")).unionAll(
        spark.createDataFrame([(None, 1, 1), (5, 7, None), (99_999, 1, 1)], "doc_id long, quality int, toxic int"))
    got = lab.sample(docs, both, "toxic", lab.fold("doc_id", 5) != 0, rows=30).collect()
    import zlib
    assert 29 <= len(got) <= 30 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 and r["label"] == 1 for r in got)


# quality

def test_interactions_in_linear_time():
    rng = np.random.default_rng(3)
    n, size = 6, fm.BUCKETS + 2 * (fm.BINS + 1)
    model = fm.QualityModel([np.array([0.5]), np.array([1.0, 2.0])], 0.3, rng.normal(size=size), rng.normal(size=(size, 4)))
    row = np.sort(rng.integers(0, n, 30))
    bucket = rng.permutation(fm.BUCKETS)[:30]
    numbers = np.column_stack([rng.random(n), np.where(np.arange(n) % 2, np.nan, rng.random(n) * 3)])
    got = model.score(row, bucket, numbers)
    r, f, x = fm.vectors(row, bucket, model.bins(numbers))
    for k in range(n):
        own = np.flatnonzero(r == k)
        z = model.bias + sum(model.weight[f[i]] * x[i] for i in own)
        z += sum(model.factor[f[i]] @ model.factor[f[j]] * x[i] * x[j] for i in own for j in own if i < j)
        assert got[k] == pytest.approx(1 / (1 + math.exp(-z)))


def test_training_learns_a_pure_interaction():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 2, 1500), rng.integers(0, 2, 1500)
    y = (a == b).astype(float)
    row = np.repeat(np.arange(1500), 2)
    feature = np.column_stack([a, 2 + b]).ravel()
    bias, w, v = fm.train(row, feature, np.ones(3000), y, 4, epochs=40)
    z = bias + w[a] + w[2 + b] + (v[a] * v[2 + b]).sum(1)
    assert ((z > 0) == (y > 0)).mean() > 0.99


def test_statistics_against_plain_code():
    texts = ["Ab c1! éé\n#x | y.", "", None, "AAA"]
    w = Words(pa.array(texts))
    row, bucket, different = fm.word_features(w)
    got = fm.statistics(w, different)
    assert different.tolist() == [len({w.text(i) for i in range(len(w)) if w.row[i] == k}) for k in range(4)]
    for k, text in enumerate(texts):
        text = text or ""
        letters = sum("A" <= c <= "Z" or "a" <= c <= "z" for c in text)
        assert got[k, 0] == pytest.approx(math.log1p(len(text.encode())))
        assert got[k, 3] == pytest.approx(sum("A" <= c <= "Z" for c in text) / max(letters, 1))
        assert got[k, 9] == pytest.approx(text.count("|") / max(w.counts()[k], 1))


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    learn = lab.fold("doc_id", 3) != 1
    model = fm.fit_quality(docs, labels, learn=learn, metadata=["n_chars"])
    got = {r["doc_id"]: r["score"] for r in fm.score_quality(docs, model, metadata=["n_chars"]).collect()}
    assert np.mean([(got[k] >= 0.5) == bool(k % 4) for k in got]) > 0.97
    again = fm.fit_quality(docs.repartition(5), labels, learn=learn, metadata=["n_chars"])
    assert np.allclose(again.weight, model.weight) and again.bias == model.bias


def test_quality_hard_cases(spark):
    docs, labels = labelled(spark, 60)
    model = fm.fit_quality(docs, labels, metadata=["n_chars"])
    hard = hard_docs(spark)
    assert fm.score_quality(hard, model, metadata=["n_chars"]).where("score >= 0 and score <= 1").count() == hard.count()
    assert fm.score_quality(empty_docs(spark), model, metadata=["n_chars"]).count() == 0
    for some in (labels.limit(0), labels.where("quality = 1")):
        none = fm.fit_quality(docs, some)
        assert fm.score_quality(docs, none).where("score >= 0.5").count() == 60


# personal data

RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_entities(text):
    out = []
    for kind, (name, rule) in enumerate(RULES):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            fine = {
                "email": True, "ip": name == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0, "phone": 9 <= len(digits) <= 15,
            }[name]
            if fine:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=300, deadline=None)
@given(st.one_of(
    st.text(alphabet="ab@.-+%", max_size=25), st.text(alphabet="0129. -+()", max_size=40), st.text(alphabet="a@.1 é+5", max_size=40)))
def test_entities_equal_the_rules(text):
    assert sorted([(a, b, k) for a, b, k, _ in di.entities(text)], key=lambda s: (s[0], s[2])) == plain_entities(text)


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1.1" * 100_000, "+1" * 100_000, "1 " * 100_000):
        di.entities(text)


def disclosure_case(spark):
    rows = [(k, f"plain words number {k} " + words(20, k, 40)) for k in range(60)]
    for k in range(6):  # one person, named near the address
        rows.append((100 + k, f"{words(15, k, 40)} call zebulon quillfeather at zq@mail.example.com today {words(15, k + 50, 40)}"))
    rows.append((110, "somewhere Quillfeather was seen"))
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("found", F.lit(1)).withColumn("row", F.lit(2))


def test_terms_that_give_a_person_away(spark):
    docs = disclosure_case(spark).repartition(3)
    got = {r["doc_id"]: r for r in di.find_disclosures(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    def marked(k):
        return [texts[k][s["start"] : s["end"]].lower() for s in got[k]["terms"]]

    assert {"zebulon", "quillfeather"} <= set(marked(100)) and "words" not in marked(100)
    assert marked(110) == ["quillfeather"] and marked(5) == []
    assert [texts[100][s["start"] : s["end"]] for s in got[100]["found"]] == ["zq@mail.example.com"]
    clean = di.sanitise(docs)
    assert clean.columns == docs.columns
    body = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert "[EMAIL]" in body[100] and "quillfeather" not in body[100] and body[5] == texts[5]


def test_disclosure_shares_against_plain_counts(spark):
    docs = disclosure_case(spark)
    scratch = di.Scratch(spark, "t")
    read = di._read(docs, "doc_id", "text")
    found = scratch.write(di.find_entities(read), "f")
    got = {r["t"]: r["share"] for r in di.disclosing_terms(found, read, scratch, 2, -99.0).collect()}
    texts = [r["text"] for r in docs.collect()]
    w = Words(pa.array(["quillfeather call today"]))
    name = {w.text(i): int(w.hash[i].astype(np.int64)) for i in range(3)}
    for term in ("quillfeather", "call", "today"):
        near = 6
        n_t = sum(term in re.findall(r"\w+", t.lower()) for t in texts)
        want = math.log(len(texts) * near / (6 * n_t)) / math.log(len(texts) / 6)
        assert got[name[term]] == pytest.approx(want)


def test_disclosure_hard_cases(spark):
    docs = hard_docs(spark)
    got = di.find_disclosures(docs)
    assert got.count() == docs.count() and got.where("size(found) > 0 or size(terms) > 0").count() == 0
    assert di.sanitise(docs).columns == docs.columns
    assert sorted(map(repr, di.sanitise(docs).select("doc_id", "text").collect())) == sorted(map(repr, docs.select("doc_id", "text").collect()))
    assert di.find_disclosures(empty_docs(spark)).count() == 0 and di.sanitise(empty_docs(spark)).count() == 0
    twice = spark.createDataFrame([(None, "a@b.cd secretive")] * 3 + [(2, "a@b.cd secretive")], "doc_id long, text string")
    assert all(len(r["found"]) == 1 for r in di.find_disclosures(twice).collect())
