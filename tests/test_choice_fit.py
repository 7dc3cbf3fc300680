"""Sampling, logit draws, capacity rounds and estimation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayplan.functions.draws import uniform
from dayplan.operators import choice
from dayplan.operators.choice import (
    capacity_choice,
    choice_table,
    draw_choice,
    mnl_probabilities,
    mnl_wide,
    sample_alternatives,
    utility,
    wide_probabilities,
)
from dayplan.operators.fit import FitResult, fit_conditional_logit
from dayplan.session import Scratch
from dayplan.specs.choice import WideLogit

TOY = WideLogit("toy", (5, 6, 9), {"intercept": {6: 0.5}, "x": {5: 1.0, 9: -2.0}, "z": {9: 0.1}})


def test_sampled_alternatives_are_distinct_and_even(spark):
    people = spark.range(3000).withColumnRenamed("id", "p")
    jobs = spark.range(100, 120).withColumnRenamed("id", "j")
    rows = sample_alternatives(people, jobs, "p", "j", 7, "s").toPandas()
    assert (rows.groupby("p")["j"].nunique() == 7).all() and len(rows) == 21000
    share = rows["j"].value_counts()
    assert len(share) == 20 and abs(share - 1050).max() < 4 * math.sqrt(3000 * 0.35 * 0.65)


def test_sample_of_all_when_there_are_few(spark):
    people = spark.range(5).withColumnRenamed("id", "p")
    jobs = spark.range(4).withColumnRenamed("id", "j")
    assert sample_alternatives(people, jobs, "p", "j", 10, "s").count() == 20
    assert sample_alternatives(people, jobs.where("false"), "p", "j", 10, "s").count() == 0


def test_wide_probabilities_and_draws(spark):
    df = spark.range(20000).select(F.col("id").alias("k"), F.lit(0.3).alias("x"), F.lit(1.0).alias("z"))
    v = np.array([0.3, 0.5, -0.6 + 0.1])
    want = np.exp(v) / np.exp(v).sum()
    row = wide_probabilities(df, TOY).first()
    assert [row["p_5"], row["p_6"], row["p_9"]] == pytest.approx(want)
    counts = mnl_wide(df, TOY, uniform("w", "k"), "c").groupBy("c").count().toPandas().set_index("c")["count"]
    for a, p in zip((5, 6, 9), want):
        assert abs(counts[a] - 20000 * p) < 4 * math.sqrt(20000 * p * (1 - p))


def test_wide_draw_is_stable_for_huge_utilities_and_unknown_for_null(spark):
    df = spark.createDataFrame([(1, 900.0, 0.0), (2, None, 0.0), (3, -900.0, 0.0)], "k long, x double, z double")
    got = {r["k"]: r["c"] for r in mnl_wide(df, TOY, uniform("w", "k"), "c").collect()}
    assert got == {1: 5, 2: None, 3: 9}


def test_long_draws_follow_probabilities_and_skip_unknown(spark):
    rows = [(p, a, v) for p in range(8000) for a, v in ((1, 0.0), (2, 1.0), (3, None), (4, -1.0))]
    df = spark.createDataFrame(rows, "p long, a long, v double")
    known = df.where("v is not null")
    sums = mnl_probabilities(known, "p", "v").groupBy("p").agg(F.sum("probability").alias("s")).agg(
        F.min("s"), F.max("s")).first()
    assert sums[0] == pytest.approx(1) and sums[1] == pytest.approx(1)
    counts = draw_choice(df, "p", "a", "v", uniform("u", "p")).groupBy("a").count().toPandas().set_index("a")["count"]
    e = {1: 1.0, 2: math.e, 4: 1 / math.e}
    for a, w in e.items():
        p = w / sum(e.values())
        assert abs(counts[a] - 8000 * p) < 4 * math.sqrt(8000 * p * (1 - p))


def test_utility_multiplies_factors(spark):
    df = spark.createDataFrame([(math.e - 1, 3.0)], "a double, b double")
    assert df.select(utility([(2.0, ["log1p(a)", "b"]), (1.0, ["b"])]).alias("v")).first()["v"] == pytest.approx(9.0)


def market(spark, people, jobs):
    choosers = spark.range(people).select(F.col("id").alias("p"), (F.col("id") % 3).cast("double").alias("h"))
    alts = spark.range(jobs).select((F.col("id") + 1000).alias("j"), (F.col("id") % 5).cast("double").alias("w"))
    inter = spark.createDataFrame(
        [(float(h), float(w), abs(h - w) * 1.0) for h in range(3) for w in range(5)], "h double, w double, far double"
    )
    return choosers, alts, inter


@pytest.mark.parametrize("people,jobs", [(60, 90), (60, 25), (30, 30)])
def test_each_job_goes_to_one_worker(spark, people, jobs):
    choosers, alts, inter = market(spark, people, jobs)
    got = capacity_choice(choosers, alts, "p", "j", [(-1.0, ["far"])], inter, ["h", "w"], k=4).toPandas()
    assert got["p"].is_unique and got["j"].is_unique
    assert len(got) == min(people, jobs)


def test_assignment_is_independent_of_partitions(spark):
    choosers, alts, inter = market(spark, 40, 50)

    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            rows = capacity_choice(
                choosers.repartition(n), alts.repartition(n), "p", "j", [(-1.0, ["far"])], inter, ["h", "w"], k=4
            )
            return sorted(map(tuple, rows.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert run(1) == run(16)


def test_workers_without_any_priced_job_stay_unplaced(spark):
    choosers, alts, inter = market(spark, 30, 60)
    got = capacity_choice(choosers, alts, "p", "j", [(-1.0, ["far"])], inter.where("h > 0"), ["h", "w"], k=4)
    assert {r["p"] % 3 for r in got.collect()} == {1, 2} and got.count() == 20


def test_no_alternatives_gives_no_rows(spark):
    choosers, alts, inter = market(spark, 3, 3)
    got = capacity_choice(choosers, alts.where("false"), "p", "j", [(-1.0, ["far"])], inter, ["h", "w"])
    assert got.columns == ["p", "j", "round"] and got.count() == 0


def test_choice_table_holds_the_chosen_one_once(spark):
    choosers, alts, inter = market(spark, 50, 20)
    seen = choosers.withColumn("j", F.col("p") % 20 + 1000)
    rows = choice_table(seen, alts, "p", "j", 6, "s", inter, ["h", "w"], chosen="j").toPandas()
    assert (rows.groupby("p")["j"].nunique() == 6).all() and len(rows) == 300
    picked = rows[rows["chosen"] == 1]
    assert len(picked) == 50 and (picked["j"] == picked["p"] % 20 + 1000).all()


def test_fit_recovers_planted_coefficients(spark):
    rng = np.random.default_rng(4)
    truth = np.array([0.8, -1.2, 0.4])
    n, j = 4000, 5
    x = rng.normal(size=(n, j, 3))
    gumbel = -np.log(-np.log(rng.random((n, j))))
    best = (x @ truth + gumbel).argmax(axis=1)
    rows = [(i, int(best[i] == a), *map(float, x[i, a])) for i in range(n) for a in range(j)]
    df = spark.createDataFrame(rows, "obs long, chosen int, a double, b double, c double").repartition(6)
    fit = fit_conditional_logit(df, "obs", "chosen", [["a"], ["b"], ["c"]])
    table = fit.table()
    for got, want in zip(table, truth):
        assert abs(got["coef"] - want) < 4 * got["std_err"]
        assert got["p"] < 0.01
    assert fit.n == n and fit.ll_null == pytest.approx(-n * math.log(j))
    # the gradient vanishes: a nudge in any direction lowers the likelihood
    def loglik(b):
        v = x @ b
        return float((v[np.arange(n), best] - np.log(np.exp(v).sum(axis=1))).sum())
    assert fit.ll == pytest.approx(loglik(np.array(fit.coef)), rel=1e-9)
    for d in np.eye(3) * 1e-3:
        assert loglik(np.array(fit.coef) + d) < fit.ll and loglik(np.array(fit.coef) - d) < fit.ll


@pytest.mark.parametrize(
    "n,j,k,ll,null,r2,aic,bic",
    [
        (8918, 10, 27, -10176.927, -20534.454, 0.504, 20407.853, 20599.441),
        (7928, 10, 28, -9037.767, -18254.895, 0.505, 18131.535, 18326.923),
        (7928, 10, 25, -9075.381, -18254.895, 0.503, 18200.762, 18375.216),
        (4681, 8, 67, -6855.951, -9733.866, 0.296, 13845.902, 14278.137),
        (9267, 4, 63, -8751.972, -12846.790, 0.319, 17629.945, 18079.400),
        (5000, 7, 71, -3589.765, -9729.551, 0.631, 7321.529, 7784.250),
    ],
)
def test_summary_identities_hold_for_the_published_fits(n, j, k, ll, null, r2, aic, bic):
    fit = FitResult(["t"] * k, [1.0] * k, np.eye(k).tolist(), n, ll, -n * math.log(j))
    assert fit.ll_null == pytest.approx(null, abs=1e-3)
    assert fit.r2 == pytest.approx(r2, abs=6e-4)
    assert fit.aic == pytest.approx(aic, abs=2e-3)
    assert fit.bic == pytest.approx(bic, abs=2e-3)


def test_the_last_workers_find_the_only_priced_job(spark):
    # three workers of one zone, 100,000 jobs, of which two lie where the workers have skims to
    workers = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 1.0)], "person_id long, zone_id_home double")
    jobs = spark.range(100_000).selectExpr("id as job_id", "cast(if(id in (777, 90000), 5, id % 4) as double) as zone_id_work")
    skims = spark.createDataFrame([(1.0, 5.0, 2.0), (1.0, 0.0, None), (9.0, 1.0, 1.0)], "zone_id_home double, zone_id_work double, dist double")
    got = capacity_choice(workers, jobs, "person_id", "job_id", [(-0.1, ["dist"])], skims, ["zone_id_home", "zone_id_work"], k=10).collect()
    assert {r["job_id"] for r in got} == {777, 90000} and len({r["person_id"] for r in got}) == 2
    assert max(r["round"] for r in got) <= 5


def test_fit_without_usable_choosers_is_unknown(spark):
    """As in a survey whose sampled alternatives all lie on zone pairs without skims."""
    rows = [(o, int(a == 0), None if a == o % 3 else float(a), 1.0) for o in range(20) for a in range(3)]
    table = spark.createDataFrame(rows, "o long, chosen int, x double, y double")
    fit = fit_conditional_logit(table, "o", "chosen", [["x"], ["x", "y"]])
    assert (fit.n, fit.names, fit.coef) == (0, ["x", "x:y"], [None, None])
    assert [r["std_err"] for r in fit.table()] == [None, None]
    assert {k: v for k, v in fit.summary().items() if v is not None} == {"n": 0, "k": 2, "df_resid": -2}


def test_rounds_join_stored_tables_by_shuffles(spark, monkeypatch):
    """However small their files are, choosers and alternatives never go to every task through the driver."""
    plans = {}
    counting = Scratch.write_counting

    def kept(self, df, name, *condition):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return counting(self, df, name, *condition)

    monkeypatch.setattr(Scratch, "write_counting", kept)
    choosers = spark.range(60).selectExpr("id as p", "id % 3 as home").coalesce(1)
    alts = spark.range(40).selectExpr("id as a", "id % 4 as work").coalesce(1)
    near = spark.range(12).selectExpr("id div 4 as home", "id % 4 as work", "cast(id as double) as d")
    placed = capacity_choice(choosers, alts, "p", "a", [(-0.1, ["d"])], near, ["home", "work"], k=3)
    assert placed.select("a").distinct().count() == placed.count() == 40
    rounds = [n for n in plans if n.startswith(("winners", "waiting", "free"))]
    assert len(rounds) > 3 and all("Join" in plans[n] for n in rounds)
    for line in "\n".join(plans[n] for n in rounds).splitlines():  # only offsets of partitions and buckets are handed on
        assert "BroadcastHashJoin" not in line or "[_bucket#" in line or "[_part#" in line, line


@pytest.mark.parametrize("gone", [[], [0, 1, 2, 3], [5], [30, 31, 32, 33, 34], list(range(0, 40, 2)), [8, 15, 16, 39]])
def test_places_of_free_alternatives(spark, monkeypatch, gone):
    monkeypatch.setattr(choice, "NUMBER_BUCKET", 8)
    free = [p for p in range(40) if p not in gone]
    rows = spark.createDataFrame([(f"p{i}", i) for i in [*range(len(free)), 0, len(free) - 1]], "p string, idx bigint")
    taken = spark.createDataFrame([(t,) for t in gone], "place bigint")
    got = choice._places(rows, taken, 40)
    assert got.columns == ["p", "place"] and got.count() == len(free) + 2
    assert {(r["p"], r["place"]) for r in got.collect()} == {(f"p{i}", place) for i, place in enumerate(free)}


def test_later_rounds_move_what_their_choosers_ask_for(spark, monkeypatch):
    """The free alternatives are not written or numbered again, and long tables are filtered before they move."""
    stored, filtered = [], []
    write, wanted = Scratch.write, choice._wanted
    monkeypatch.setattr(Scratch, "write", lambda self, df, name: stored.append(name) or write(self, df, name))
    monkeypatch.setattr(choice, "_wanted", lambda table, rows, on, n: filtered.append(on) or wanted(table, rows, on, n))
    choosers = spark.range(30).selectExpr("id as p", "double(id % 3) as home")
    # job 7 twice, one job without a key
    alts = spark.range(2000).selectExpr("if(id = 1999, null, if(id = 8, 7, id)) as a", "double(id % 40) as work")
    near = spark.range(120).selectExpr("double(id div 40) as home", "double(id % 40) as work", "if(id % 40 < 4, id / 10d, null) as d")

    def rounds(selective, bucket):
        monkeypatch.setattr(choice, "SELECTIVE", selective)
        monkeypatch.setattr(choice, "NUMBER_BUCKET", bucket)
        found = capacity_choice(choosers, alts, "p", "a", [(-0.1, ["d"])], near, ["home", "work"], k=4)
        return sorted(map(tuple, found.collect()))

    few = rounds(0, 1 << 16)
    assert filtered.count(["place"]) > 2 and filtered.count(["home", "work"]) > 2
    assert not [n for n in stored if n.startswith("free")] and "rows" in stored
    all_ = rounds(10**9, 8)
    assert few == all_ and max(r[2] for r in few) > 3 and len(few) == 30
