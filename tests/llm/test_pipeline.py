"""The corpus pipeline stage by stage on a small corpus, against plain code."""

import re

import corpus_pipeline as pipeline
import pytest
from dayplan.llm.tokens import encoder
from tests.llm.helpers import DOCS, empty_docs, hard_docs, words
from tests.llm.test_set_operators import edited, plain_classes
from tests.llm.test_text_operators import plain_hits


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = [], []
    for k in range(240):
        body = words(60, k, 3000) + (" you utter moron scum" if k % 6 == 0 else "")
        rows.append((k, body, "en", f"s{k % 3}" if k % 7 else None, len(body)))
        labels.append((k, 1, int(k % 6 == 0)))
    rows += [(300 + k, edited(rows[k][1], [5], "edit"), "en", "s1", 1) for k in range(1, 40) if k % 6]
    rows += [(400 + k, words(30, 7000 + k, 3000) + " " + words(15, 8000, 900), "en", "s2", 1) for k in range(5)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, words(15, 8000, 900))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_take_effect(spark, folder):
    from dayplan.llm.shared import Scratch

    docs = first = spark.read.parquet(f"{folder}/documents.parquet")
    scratch, kept = Scratch(spark, "t"), {}
    for name, stage in pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, folder), name)
        kept[name] = docs
        assert name == "tokens" or docs.schema == first.schema
    text = {r["doc_id"]: r["text"] for r in first.collect()}
    ids = {name: sorted(r["doc_id"] for r in df.collect()) for name, df in kept.items()}
    assert ids["toxicity"] == sorted(k for k, t in text.items() if "moron" not in t)
    classes = plain_classes([(k, text[k]) for k in ids["toxicity"]])
    assert ids["near_duplicates"] == sorted({c[1] for c in classes})
    assert ids["decontaminate"] == [k for k in ids["near_duplicates"] if not plain_hits(text[k], [(1, words(15, 8000, 900))])[1]]
    assert set(ids["mix"]) <= set(ids["decontaminate"]) and all(ids["mix"].count(k) <= 3 for k in set(ids["mix"]))
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", text[k])) for k in text}
    budget = sum(size[k] for k in ids["decontaminate"])
    assert budget <= sum(size[k] for k in ids["mix"]) < budget + max(size.values())
    assert ids["tokens"] == ids["mix"]
    for r in kept["tokens"].collect():
        assert r["n_tokens"] == len(encoder().ids([text[r["doc_id"]]])[0]) // 2 + 1


def test_run_gives_the_last_stage(spark, folder):
    got = pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 100


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_every_stage_takes_hard_tables(spark, folder, name):
    stage = dict(pipeline.STAGES)[name]
    docs = hard_docs(spark)
    out = stage(spark, docs, folder)
    assert out.count() > 0 and (name == "tokens" or out.columns == docs.columns)
    assert stage(spark, empty_docs(spark), folder).count() == 0
