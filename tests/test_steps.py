"""Stored steps and fingerprints."""

import threading

import pytest
from pyspark.sql import functions as F

from dayplan.plans import steps
from dayplan.plans.steps import Steps, fingerprint
from dayplan.session import side_by_side


def test_a_step_is_built_once_and_a_cut_off_one_again(spark, tmp_path):
    path, calls = str(tmp_path / "run"), []

    def build(n, fails=False):
        def make():
            calls.append(n)
            df = spark.range(n)
            return df.withColumn("id", F.raise_error("cut off").cast("bigint")) if fails else df
        return make

    first = Steps(spark, path, "k")
    assert first.table("a", build(3)).count() == 3
    with pytest.raises(Exception, match="cut off"):
        first.table("b", build(4, fails=True))
    again = Steps(spark, path, "k")
    assert again.table("a", build(9)).count() == 3  # not built again
    assert again.table("b", build(5)).count() == 5
    assert again.table("none", lambda: spark.range(0)).columns == ["id"]
    assert Steps(spark, path, "other").table("a", build(6)).count() == 6
    assert Steps(spark, path, "k").table("b", build(8)).count() == 5
    assert calls == [3, 4, 5, 6]
    kept_for_one_run = Steps(spark)
    assert kept_for_one_run.table("a", build(2)).count() == 2 and Steps(spark).table("a", build(7)).count() == 7


def test_fingerprint_follows_rows_and_settings(spark):
    rows = [(1, "a", None), (2, None, 0.5), (2, None, 0.5)]
    df = spark.createDataFrame(rows, "k long, `a.b` string, v double")
    one = fingerprint({"t": df}, {"seed": "1"})
    assert one == fingerprint({"t": df.repartition(5, "k").orderBy("v")}, {"seed": "1"})
    assert one == fingerprint({"t": df.select("v", "`a.b`", "k")}, {"seed": "1"})
    others = [
        fingerprint({"t": df}, {"seed": "2"}), fingerprint({"u": df}, {"seed": "1"}), fingerprint({}, {"seed": "1"}),
        fingerprint({"t": df.distinct()}, {"seed": "1"}), fingerprint({"t": df.limit(0)}, {"seed": "1"}),
        fingerprint({"t": df.withColumn("v", F.coalesce("v", F.lit(1.0)))}, {"seed": "1"}),
        fingerprint({"t": df.withColumn("k", F.col("k").cast("int"))}, {"seed": "1"}),
        fingerprint({"t": spark.createDataFrame([(1, None, None), (2, "a", 0.5), (2, None, 0.5)], df.schema)}, {"seed": "1"}),
    ]
    assert len({one, *others}) == len(others) + 1


def test_fingerprint_hashes_values_as_they_are(spark, monkeypatch):
    wide = spark.range(50).selectExpr(*[f"if(id % 7 = {i % 7}, null, id * {i}d) as c{i}" for i in range(40)], "array(id, null) as l")
    texts, to_json = [], F.to_json
    monkeypatch.setattr(steps.F, "to_json", lambda c: texts.append(c) or to_json(c))
    one = fingerprint({"t": wide}, {})
    assert len(texts) == 1  # the nested column only
    moved = wide.selectExpr(*[f"c{39 - i} as c{i}" for i in range(40)], "l")
    assert len({one, fingerprint({"t": wide.repartition(3)}, {}), fingerprint({"t": moved}, {}),
                fingerprint({"t": wide.selectExpr("* except (l)", "array(null, element_at(l, 1)) as l")}, {})}) == 3


def test_steps_run_side_by_side(spark, tmp_path):
    both, path = threading.Barrier(2, timeout=60), str(tmp_path / "run")
    kept = Steps(spark, path, "k")

    def build(n):
        both.wait()  # neither goes on alone
        return spark.range(n)

    a, b = side_by_side(lambda: kept.table("a", lambda: build(3)), lambda: kept.table("b", lambda: build(4)))
    assert (a.count(), b.count()) == (3, 4) and set(Steps(spark, path, "k").done) == {"a", "b"}
    with pytest.raises(ZeroDivisionError):
        side_by_side(lambda: 1 // 0, lambda: 2)


def test_both_networks_are_worked_out_side_by_side(spark, folder, monkeypatch):
    from checks import all_queries, fixtures

    all_queries()
    from checks import q_network

    both, seen = threading.Barrier(2, timeout=60), []

    def nodes(kind):
        def build(m):
            seen.append("_located" in m._tables)  # what both need is there before
            both.wait()
            return kind
        return build

    monkeypatch.setattr(q_network, "located", lambda m: m._tables.setdefault("_located", {}))
    for kind in ("walk", "drive"):
        monkeypatch.setattr(q_network, f"{kind}_nodes", nodes(kind))
    assert q_network.both_nodes(fixtures.Model(spark, folder)) == {"nodeswalk": "walk", "nodessmall": "drive"}
    assert seen == [True, True]
