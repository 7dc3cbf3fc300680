"""Departure laws, plans, files, the whole run."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayplan.functions.draws import open_uniform
from dayplan.functions.laws import normal_quantile
from dayplan.operators.qa import describe, profile
from dayplan.plans.activities import activity_plans
from dayplan.plans.departures import departure_times, early_24, ordered_22
from dayplan.plans.pipeline import run, run_coverage
from dayplan.sources.readers import conform, load_or_impute_skims, read_table
from dayplan.sources.writers import accessibility, write_archive, write_outputs, write_table
from dayplan.specs.departures import EARLY_24, HOME_TO_WORK, LATE_24, WORK_TO_HOME

LAWS = {
    **{f"hw{c}": law for c, law in HOME_TO_WORK.items()},
    **{f"wh{c}": law for c, law in WORK_TO_HOME.items()},
    "hw24a": EARLY_24, "hw24b": LATE_24,
}

# F(low), F(high) of the closed forms, from independent hand-written distribution functions
MASSES = {
    "hw2": (0.010532, 0.999521), "hw3": (0.010296, 0.995289), "wh3": (0, 0.998696), "wh12": (0.000937, 1),
    "wh14": (0, 0.999398), "hw22": (0, 0.996663), "wh22": (0.020575, 0.998113), "hw23": (0.038434, 0.830791),
    "wh23": (0.010847, 0.999910), "wh24": (0, 1), "hw24a": (0, 1), "hw24b": (0.002007, 0.999873),
}


@pytest.fixture(scope="module")
def law_draws(spark):
    df = spark.range(20000).withColumn("u", open_uniform("ks", "id"))
    return df.select("u", *[law.quantile(F.col("u")).alias(n) for n, law in LAWS.items()]).toPandas()


@pytest.mark.parametrize("name", list(LAWS))
def test_draws_follow_the_truncated_law(law_draws, name):
    """Kolmogorov-Smirnov distance to the distribution function integrated numerically."""
    law = LAWS[name]
    t = np.sort(law_draws[name].to_numpy())
    assert t[0] >= law.low - 1e-9 and t[-1] <= law.high + 1e-9
    if law.tabulated:
        a, b = law._support
        z = np.linspace(a, b, 400_001)
        f = law.density(z)
        f = np.where(np.isfinite(f), f, 0.0)
        cum = np.concatenate([[0.0], np.cumsum((f[1:] + f[:-1]) / 2)])
        theory = np.interp((t - law.loc) / law.scale, z, cum / cum[-1])
    else:
        low, high = law.mass
        assert (low, high) == pytest.approx(MASSES[name], abs=2e-6)
        theory = np.array([(law.cdf((x - law.loc) / law.scale) - low) / (high - low) for x in t])
    steps = np.arange(1, len(t) + 1) / len(t)
    assert np.abs(theory - steps).max() < 1.95 / math.sqrt(len(t))


@pytest.mark.parametrize("name", [n for n, law in LAWS.items() if not law.tabulated])
def test_quantile_inverts_the_distribution_function(law_draws, name):
    law = LAWS[name]
    low, high = law.mass
    for u, t in list(zip(law_draws["u"], law_draws[name]))[:300]:
        back = (law.cdf((t - law.loc) / law.scale) - low) / (high - low)
        assert back == pytest.approx(u, abs=2e-8)


def test_normal_quantile(spark):
    ps = [1e-6, 0.001, 0.02425, 0.3, 0.5, 0.7, 0.99, 1 - 1e-6]
    df = spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p")).alias("z"))
    for p, r in zip(ps, df.collect()):
        assert 0.5 * math.erfc(-r["z"] / math.sqrt(2)) == pytest.approx(p, rel=2e-8)


@pytest.fixture(scope="module")
def times(spark):
    codes = [2, 3, 12, 13, 14, 22, 23, 24]
    persons = spark.range(6000).select(
        F.col("id").alias("person_id"),
        F.element_at(F.array(*[F.lit(c).cast("long") for c in codes]), (F.col("id") % 8 + 1).cast("int")).alias("TOD"),
    )
    extra = spark.createDataFrame([(90001, None), (90002, 99)], "person_id long, TOD long")
    return departure_times(persons.unionByName(extra)).toPandas()


def test_departures_stay_in_their_windows(times):
    assert len(times) == 6000
    for code, g in times.groupby("TOD"):
        laws = [HOME_TO_WORK[code]] if code in HOME_TO_WORK else [EARLY_24, LATE_24]
        assert g["HW_ST"].between(min(x.low for x in laws), max(x.high for x in laws)).all()
        wh = WORK_TO_HOME[code]
        ok = g["WH_ST"].between(wh.low, min(wh.high, 24.0))
        if wh.high > 24:
            ok |= g["WH_ST"].between(0, wh.high - 24)
        assert ok.all()
    g = times[times["TOD"] == 22]
    assert (g["HW_ST"] < g["WH_ST"]).all()


def test_early_share_of_code_24_is_exact(spark, times):
    g = times[times["TOD"] == 24]
    assert (g["HW_ST"] < 12).sum() == round(len(g) * 241 / 377)
    few = spark.createDataFrame([(i, 24) for i in range(3)], "person_id long, TOD long")
    rows, n = early_24(few)
    assert n == 3 and sum(r["early"] for r in rows.collect()) == 2
    none, n = early_24(few.where("false"))
    assert n == 0 and none.count() == 0


def test_pairs_out_of_order_are_drawn_again(spark):
    df = spark.range(20_000).select(F.col("id").alias("person_id"))
    rows = df.select(ordered_22("x").alias("p")).select("p.hw", "p.wh").toPandas()
    assert (rows["hw"] < rows["wh"]).all()
    home, work = HOME_TO_WORK[22], WORK_TO_HOME[22]
    assert rows["hw"].between(home.low, home.high).all() and rows["wh"].between(work.low, work.high).all()
    # the same law as drawing both on their own until they are in order
    free = df.select(home.quantile(open_uniform("free", "person_id", slot=0)).alias("hw"),
                     work.quantile(open_uniform("free", "person_id", slot=1)).alias("wh")).where("hw < wh").toPandas()
    assert len(free) > 1000
    for column in ("hw", "wh"):
        a, b = np.sort(rows[column].to_numpy()), np.sort(free[column].to_numpy())
        every = np.concatenate([a, b])
        gap = np.abs(np.searchsorted(a, every, "right") / len(a) - np.searchsorted(b, every, "right") / len(b)).max()
        assert gap < 1.95 * math.sqrt(1 / len(a) + 1 / len(b)), column  # one in a thousand by chance


def test_plans_of_every_order(spark):
    trips = spark.createDataFrame(
        [(1, 8.0, 17.0), (2, 12.0, 1.0), (3, None, 17.0), (4, 8.0, None), (5, None, None), (6, 9.0, 9.0)],
        "person_id long, Home double, Work double",
    ).selectExpr("*", "1D as x_home", "2D as y_home", "3D as x_work", "4D as y_work")
    got = {}
    for r in activity_plans(trips).collect():
        got.setdefault(r["personId"], []).append(tuple(r)[1:])
    for person, rows in got.items():
        rows.sort(key=lambda r: r[1])
        assert [r[1] for r in rows] == [1, 2, 3, 4, 5]
        assert [r[0] for r in rows] == ["activity", "leg", "activity", "leg", "activity"]
        assert rows[1][2:] == ("", None, None, None) == rows[3][2:]
        assert rows[4][2:5] == rows[0][2:5] and rows[4][5] is None
    starts = {p: (rows[0][2], rows[0][5], rows[2][5]) for p, rows in got.items()}
    assert starts == {
        1: ("Home", 8.0, 17.0), 2: ("Work", 1.0, 12.0), 3: ("Work", 17.0, None), 4: ("Home", 8.0, None),
        5: ("Home", None, None), 6: ("Home", 9.0, 9.0),
    }
    assert got[1][0][3:5] == (1.0, 2.0) and got[1][2][3:5] == (3.0, 4.0)


# ---------------------------------------------------------------- files


def text_file(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_readers_resolve_keys_and_types(spark, tmp_path):
    parcels = text_file(tmp_path / "p.csv", ["primary_id,block_id,apn,zone_id,x", "1,060010001,007,3.0,1.5", "2,,,,"])
    rows = read_table(spark, "parcels", parcels).orderBy("parcel_id").collect()
    assert rows[0].asDict() == {"parcel_id": 1, "block_id": "060010001", "apn": "007", "zone_id": 3, "x": 1.5}
    assert rows[1]["zone_id"] is None
    jobs = text_file(tmp_path / "j.csv", ["Unnamed: 0,building_id,sector_id", "11,5,44"])
    assert read_table(spark, "jobs", jobs).first().asDict() == {"job_id": 11, "building_id": 5, "sector_id": 44}
    zones = text_file(tmp_path / "z.csv", ["zone_id,tract,score", "4,abc,2.5"])
    assert read_table(spark, "zones", zones).first().asDict() == {"zone_id": 4, "score": 2.5}
    with pytest.raises(ValueError):
        read_table(spark, "units", jobs)
    with pytest.raises(ValueError):
        read_table(spark, "jobs", jobs, "h5")


def test_rentals_and_sqft_rules(spark):
    rentals = spark.createDataFrame(
        [(1, 50.0, 0.1), (2, 20000.0, 60.0), (3, None, None), (4, 500.0, 2.0)], "pid long, rent double, rent_sqft double"
    )
    got = {r["pid"]: (r["rent"], r["rent_sqft"]) for r in conform(rentals, "rentals").collect()}
    assert got == {1: (100.0, 0.2), 2: (10000.0, 50.0), 3: (None, None), 4: (500.0, 2.0)}
    buildings = spark.createDataFrame(
        [(1, 10.0, 0.0), (2, 0.0, 0.0), (3, 10.0, 4.0)],
        "building_id long, residential_sqft double, residential_units double",
    )
    got = {r["building_id"]: r["res_sqft_per_unit"] for r in conform(buildings, "buildings").collect()}
    assert got == {1: 0.0, 2: None, 3: 2.5}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_skims_are_loaded_or_imputed(spark, tmp_path, fmt):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        load_or_impute_skims(spark, base, fmt)
    mtc = spark.createDataFrame([(1, 1, 1.0), (1, 2, 2.0)], "orig long, dest long, da_distance_AM double")
    raw = spark.createDataFrame(
        [(1, 1, "CAR", 8, 600.0, 1.0, 500.0, 2)],
        "origTaz long, destTaz long, mode string, hour long, generalizedTimeInS double, generalizedCost double, "
        "distanceInM double, numObservations long",
    )
    write_table(mtc, f"{base}/mtc_skims.{fmt}", fmt)
    write_table(raw, f"{base}/beam_skims_raw.{fmt}", fmt)
    first = {r["to_zone_id"]: r["gen_tt_CAR"] for r in load_or_impute_skims(spark, base, fmt).collect()}
    assert first[1] == 10.0 and first[2] == pytest.approx(2 * 10.0)
    # now stored: the raw table is not needed any more
    again = {r["to_zone_id"]: r["gen_tt_CAR"] for r in load_or_impute_skims(spark, base, fmt).collect()}
    assert again == pytest.approx(first)


def test_accessibility_is_computed_once_then_read(spark, tmp_path):
    built = {
        n: spark.createDataFrame([(1, 2.5)], f"{k} long, v double")
        for n, k in (("nodeswalk", "osmid"), ("nodessmall", "osmid"), ("zones", "zone_id"))
    }
    for fmt in ("csv", "parquet"):
        accessibility(spark, str(tmp_path), "compute", lambda: built, fmt)
        stored = accessibility(spark, str(tmp_path), "stored", fmt=fmt)
        assert {n: tuple(df.first()) for n, df in stored.items()} == {n: (1, 2.5) for n in built}
    with pytest.raises(ValueError):
        accessibility(spark, str(tmp_path), "other")
    with pytest.raises(ValueError):
        accessibility(spark, str(tmp_path), "compute")


def test_profile_and_describe(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "a double")
    assert profile(df, ["a"]).first()[:4] == ("a", 2, 2.0, pytest.approx(math.sqrt(2)))
    assert describe(df).where("summary = 'count'").first()["a"] == "2"


# ---------------------------------------------------------------- the whole run


@pytest.fixture(scope="module")
def day(spark, model, tmp_path_factory):
    names = ("parcels", "buildings", "units", "households", "persons", "jobs", "establishments", "zones",
             "mtc_skims", "beam_skims_raw", "zone_accessibility", "rentals", "access_indicators")
    tables = {n: conform(model[n], n) for n in names}
    for kind in ("drive", "walk"):
        tables[f"{kind}_nodes"], tables[f"{kind}_edges"] = model["nodes"], model["edges"]
    path = str(tmp_path_factory.mktemp("access"))
    return run(spark, tables, seed="7", access_path=path), tables, path


def test_run_places_every_worker_once(day, spark):
    out, tables, _ = day
    persons = out["persons"].where("job_id is not null")
    n = persons.count()
    assert n == persons.select("job_id").distinct().count() > 600
    assert persons.where("worker = 0 or work_at_home = 1").count() == 0
    assert persons.where("TOD is null or HW_ST is null or WH_ST is null").count() == 0
    assert out["persons"].count() == tables["persons"].count()
    assert out["plans"].count() == 5 * n
    # every household with a unit, building and parcel whose block has indicators, and no other
    block = tables["units"].select("unit_id", "building_id").join(tables["buildings"].select("building_id", "parcel_id"), "building_id").join(
        tables["parcels"].select("parcel_id", "block_id"), "parcel_id").join(
        tables["access_indicators"].select("block_id").distinct(), "block_id").select("unit_id")
    able = {r[0] for r in tables["households"].join(block, "unit_id").select("household_id").collect()}
    assert {r[0] for r in out["households"].where("cars_alt is not null").select("household_id").collect()} == able and able
    assert {r[0] for r in out["households"].select("cars_alt").distinct().collect()} <= {None, 0, 1, 2, 3}
    # afternoon returns of morning commuters have no period, hence no mode
    modes = out["persons_CHTS_format"]
    assert modes.where("TOD is null and primary_commute_mode is not null").count() == 0
    assert modes.where("TOD is not null and primary_commute_mode is null").count() == 0
    cover = {r["step"]: (r["covered"], r["total"]) for r in run_coverage(out).collect()}
    assert cover["plans"] == (n, n) and cover["departure"] == (n, n) and cover["workplace"][0] == n


def test_run_from_stored_accessibility_is_the_same(day, spark):
    out, tables, path = day
    again = run(spark, tables, seed="7", mode="stored", access_path=path)
    key = ["person_id", "job_id", "TOD", "HW_ST", "WH_ST"]
    assert again["persons"].select(key).exceptAll(out["persons"].select(key)).isEmpty()


def test_a_run_that_stopped_goes_on_behind_its_last_step(day, spark, tmp_path, monkeypatch):
    from dayplan.plans import pipeline

    out, tables, _ = day

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(pipeline, "tod_choice_simulate", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            run(spark, tables, seed="7", resume_path=str(tmp_path))
    with monkeypatch.context() as m:
        for done in ("impute_skims", "node_variables", "zone_access", "wlcm_simulate"):
            m.setattr(pipeline, done, stop)
        again = run(spark, tables, seed="7", resume_path=str(tmp_path))
        with pytest.raises(RuntimeError, match="stopped"):
            run(spark, tables, seed="8", resume_path=str(tmp_path))
    for name, key in (("persons", ["person_id", "job_id", "TOD", "HW_ST", "WH_ST"]), ("households", ["household_id", "cars_alt"]),
                      ("persons_CHTS_format", ["person_id", "primary_commute_mode"]),
                      ("plans", ["personId", "planElementIndex", "activityType", "x", "y", "endTime"])):
        assert again[name].select(key).exceptAll(out[name].select(key)).isEmpty()
        assert out[name].select(key).exceptAll(again[name].select(key)).isEmpty()


def test_outputs_are_written(day, spark, tmp_path):
    out, _, _ = day
    names = write_outputs(out, str(tmp_path))
    assert len(names) == 16
    back = spark.read.parquet(f"{tmp_path}/plans.parquet")
    assert back.count() == out["plans"].count()
    assert spark.read.csv(f"{tmp_path}/plans.csv", header=True).columns == out["plans"].columns
    assert len(write_archive(out, str(tmp_path / "archive"))) == 6


def test_chunked_sources_give_the_same_variables(day):
    from dayplan.plans.access import attach_node_ids, node_variables

    out, tables, _ = day
    located = attach_node_ids({**tables, "persons": tables["persons"]})
    chunked = node_variables(located, "walk", chunks=2)
    whole = out["nodeswalk"].select(*chunked.columns)
    assert chunked.exceptAll(whole).isEmpty() and whole.exceptAll(chunked).isEmpty()
