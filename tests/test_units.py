"""Null rules, dummies, joins, order statistics, dense index."""

import math
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from dayplan.functions.draws import uniform
from dayplan.functions.nulls import clamp, flag, ratio, recode, wrap_day, zero_fill
from dayplan.operators.columns import (
    add_household_columns,
    fill_median,
    household_columns,
    job_columns,
    person_columns,
)
from dayplan.operators.dense_index import dense_index
from dayplan.operators.order_stats import exact_medians, order_statistics
from dayplan.operators.relations import complement, filter_all, lookup, merge_tables, update_column
from dayplan.operators.zones import zone_avg_income, zone_totals
from dayplan.session import scratch_dir
from dayplan.sources.readers import fill_access_indicators
from dayplan.specs import choice, network, recodes, tables
from dayplan.specs.departures import EARLY_24, HOME_TO_WORK, LATE_24, WORK_TO_HOME

INF = float("inf")


def column(df, name="v"):
    return [r[name] for r in df.collect()]


def test_counts_of_derived_columns_and_coefficients(spark):
    assert len(network.drive_variables()) == 37
    assert len(network.walk_variables()) == 55
    assert len({v.name for v in network.drive_variables() + network.walk_variables()}) == 92
    zone_columns, node_columns, zone_ids = 5, 14, 2
    total = (
        zone_columns + node_columns + zone_ids + len(network.drive_ratios())
        + len(network.walk_ratios()) + len(job_columns()) + len(person_columns())
        + len(household_columns()) + len(recodes.PARCEL_ACCESS)
    )
    assert total == 104

    def parameters(spec):
        shared = choice.SHARED_COEFFICIENTS.get(spec.name, ())
        return sum(1 if a in shared else len(c) for a, c in spec.coefficients.items())

    assert parameters(choice.TOD_CHOICE) == 67
    assert parameters(choice.AUTO_OWNERSHIP) == 63
    assert parameters(choice.MODE_CHOICE) == 71
    assert [len(choice.WORKPLACE_MODELS[n]) for n in ("WLCM_gen_tt_simple", "WLCM_gen_tt", "WLCM")] == [25, 28, 27]
    assert len(HOME_TO_WORK) + len(WORK_TO_HOME) + len([EARLY_24, LATE_24]) == 17
    assert len(tables.OUTPUT_TABLES) == 16 and len(tables.RELATIONS) == 12


def test_unknown_comparison_is_zero(spark):
    df = spark.createDataFrame([(1.0,), (None,), (9.0,)], "a double").select(flag(F.col("a") < 5).alias("v"))
    assert column(df) == [1, 0, 0]


def test_division_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 0.0)], "n double, d double")
    assert column(df.select(ratio(F.col("n"), F.col("d")).alias("v"))) == [INF, -INF, None, 2.0, None]


def test_clamp_fill_recode_wrap(spark):
    df = spark.createDataFrame([(50.0, "1"), (None, "1234567890123456"), (200.0, None)], "a double, b string")
    assert column(df.select(clamp(F.col("a"), 100.0, 150.0).alias("v"))) == [100.0, None, 150.0]
    assert column(df.select(zero_fill(F.col("b"), 15).alias("v"))) == ["000000000000001", "1234567890123456", None]
    codes = spark.createDataFrame([(1,), (4,), (8,), (77,), (None,)], "r int")
    assert column(codes.select(recode(F.col("r"), recodes.RACE).alias("v"))) == [1, 3, 97, None, None]
    hours = spark.createDataFrame([(23.0,), (24.0,), (25.5,), (None,)], "h double")
    assert column(hours.select(wrap_day(F.col("h")).alias("v"))) == [23.0, 24.0, 1.5, None]


def test_middle_income_band_is_bounded_by_household_size_unless_strict(spark):
    row = (90000.0, 2.0, 1, 1, 1)
    df = spark.createDataFrame([row], "income double, persons double, tenure int, single_family int, building_type int")
    assert add_household_columns(df).first()["hh_inc_25_to_75k"] == 1
    assert add_household_columns(df, strict_income=True).first()["hh_inc_25_to_75k"] == 0


def test_income_bins_are_right_closed(spark):
    df = spark.createDataFrame(
        [(v, 1.0, 1, 1, 1) for v in (0.0, 20000.0, 20001.0, 120000.0, 120001.0, -5.0)],
        "income double, persons double, tenure int, single_family int, building_type int",
    )
    names = [n for n, _, _ in recodes.INCOME_BINS]
    hits = [[n for n in names if r[n]] for r in add_household_columns(df).collect()]
    assert hits == [["income_2"], ["income_2"], ["income_4"], ["income_12"], ["income_12p"], []]


@pytest.mark.parametrize("bins", [1024, 4, 2])
def test_medians_match_sorted_values(spark, bins):
    rng = random.Random(7)
    cols = {
        "few": [float(rng.choice([1, 2, 2, 2, 3])) for _ in range(101)],
        "wide": [rng.lognormvariate(0, 20) for _ in range(101)],
        "signed": [rng.gauss(0, 1e6) for _ in range(101)],
        "inf": [INF if i % 3 == 0 else (-INF if i % 17 == 0 else float(i)) for i in range(101)],
        "mostly_inf": [INF if i % 3 else 1.0 for i in range(101)],
        "tiny": [5e-324 * (i % 7) for i in range(101)],
        "near": [1.0 + 2.220446049250313e-16 * (i % 3) for i in range(101)],
        "widest": [(-1) ** i * 1.7e308 / (1 + i % 5) for i in range(101)],
        "gaps": [None if i % 4 == 0 else float("nan") if i % 4 == 1 else float(i) for i in range(101)],
    }
    rows = [tuple(cols[c][i] for c in cols) for i in range(100)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(7)
    found = exact_medians(df, list(cols), bins=bins)
    for c in cols:
        known = sorted(v for v in cols[c][:100] if v is not None and not math.isnan(v))
        a, b = known[(len(known) - 1) // 2], known[len(known) // 2]
        assert found[c] == (a if a == b else a + (b - a) / 2), c


def test_order_statistics_of_empty_and_single(spark):
    df = spark.createDataFrame([(5.0,)], "a double")
    assert order_statistics(df, {"a": [0]}) == {"a": [5.0]}
    assert exact_medians(df.where("false"), ["a"]) == {"a": None}


def test_fill_median_counts_infinities_before_they_are_replaced(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (INF,), (INF,), (3.0,), (None,)], "a double")
    assert sorted(column(fill_median(df, ["a"]), "a")) == [1.0, 2.0, 3.0, 3.0, 3.0, 3.0]


def test_dense_index_is_the_rank(spark):
    ids = random.Random(3).sample(range(10**9), 2000)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(13)
    out, n = dense_index(df, "id")
    got = {r["id"]: r["idx"] for r in out.collect()}
    assert n == 2000
    assert got == {v: i for i, v in enumerate(sorted(ids))}


def test_uniform_is_independent_of_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    one = {r["k"]: r["u"] for r in df.coalesce(1).withColumn("u", uniform("s", "k")).collect()}
    many = {r["k"]: r["u"] for r in df.repartition(16).withColumn("u", uniform("s", "k")).collect()}
    assert one == many and 0.4 < sum(one.values()) / 500 < 0.6


def test_lookup_keeps_children_and_merge_drops_them(spark):
    kids = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "household_id long, unit_id long")
    units = spark.createDataFrame([(10, 7)], "unit_id long, building_id long")
    found = lookup(kids, "unit_id", units, "unit_id", {"building_id": "b"})
    assert {r["household_id"]: r["b"] for r in found.collect()} == {1: 7, 2: None, 3: None}
    merged = merge_tables({"households": kids, "units": units}, "households", ["households", "units"])
    assert [r["household_id"] for r in merged.collect()] == [1]
    with pytest.raises(ValueError):
        merge_tables({"households": kids, "zones": units}, "households", ["households", "zones"])


def test_merge_keeps_the_column_of_the_nearer_table(spark):
    households = spark.createDataFrame([(1, 10, 5)], "household_id long, unit_id long, building_id long")
    units = spark.createDataFrame([(10, 7)], "unit_id long, building_id long")
    buildings = spark.createDataFrame([(7, 70)], "building_id long, parcel_id long")
    row = merge_tables(
        {"households": households, "units": units, "buildings": buildings}, "households",
        ["households", "units", "buildings"],
    ).first()
    assert row["building_id"] == 5 and row["parcel_id"] == 7 * 10


def test_update_filter_complement(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k long, v long")
    new = spark.createDataFrame([(1, 50), (2, 60), (9, 90)], "k long, v long")
    assert {r["k"]: r["v"] for r in update_column(df, "k", new, "v").collect()} == {1: 50, 2: 60, 3: 7}
    added = update_column(df.drop("v"), "k", new, "v")
    assert {r["k"]: r["v"] for r in added.collect()} == {1: 50, 2: 60, 3: None}
    none = spark.createDataFrame([(1, None)], "k long, v long")
    assert {r["k"]: r["v"] for r in update_column(df, "k", none, "v").collect()} == {1: None, 2: None, 3: 7}
    assert column(filter_all(df, ["v > 4", "k < 3"]), "k") == [1]
    assert column(complement(df, new, "k"), "k") == [3]


def test_indicators_fill_null_and_nan(spark):
    nan = float("nan")
    rows = [("1", 1.0), ("2", 3.0), ("3", nan), ("4", None)]
    got = fill_access_indicators(spark.createDataFrame(rows, "block_id string, a double")).collect()
    assert sorted((int(r["block_id"]), r["a"]) for r in got) == [(1, 1.0), (2, 3.0), (3, 2.0), (4, 2.0)]


def test_zone_totals_and_mean_of_means(spark):
    t = {
        "zones": spark.createDataFrame([(1,), (2,)], "zone_id long"),
        "parcels": spark.createDataFrame([(1, 1), (2, 1)], "parcel_id long, zone_id long"),
        "buildings": spark.createDataFrame(
            [(1, 1, 3.0), (2, 1, 4.0), (3, 2, None)], "building_id long, parcel_id long, residential_units double"
        ),
        "households": spark.createDataFrame(
            [(1, 1, 10.0, 1.0), (2, 1, 20.0, 2.0), (3, 2, 40.0, 1.0), (4, 3, 100.0, 5.0), (5, None, 9.0, 9.0)],
            "household_id long, building_id long, income double, persons double",
        ),
        "jobs": spark.createDataFrame([(1, 1), (2, 3), (3, 3), (4, 77), (5, None)], "job_id long, building_id long"),
    }
    rows = {r["zone_id"]: r.asDict() for r in zone_totals(t).collect()}
    assert rows[1] == {"zone_id": 1, "total_jobs": 3, "sum_residential_units": 7.0, "sum_persons": 9.0,
                       "sum_income": 170.0}
    assert rows[2]["total_jobs"] == 0 and rows[2]["sum_income"] == 0
    means = {r["zone_id"]: r["avg_income"] for r in zone_avg_income(t).collect()}
    # buildings 15 and 40 -> parcel 27.5; parcels 27.5 and 100 -> 63.75
    assert means == {1: 63.75, 2: 0.0}


def fake_session(configured, current, master):
    context = SimpleNamespace(getCheckpointDir=lambda: current, master=master)
    conf = SimpleNamespace(get=lambda key, default: configured if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_scratch_folder_is_the_one_the_cluster_names():
    assert scratch_dir(fake_session("hdfs://shared/ck/", None, "yarn")) == "hdfs://shared/ck"
    assert scratch_dir(fake_session(None, "s3a://b/ck", "yarn")) == "s3a://b/ck"
    with pytest.raises(RuntimeError):
        scratch_dir(fake_session(None, None, "yarn"))


def test_pair_lookup_deals_out_a_hot_pair(spark, monkeypatch):
    from dayplan.operators import relations

    monkeypatch.setattr(relations, "PART_ROWS", 500)
    pair = lambda i: (1.0, 2.0) if i % 3 == 0 else (None, 2.0) if i % 3 == 1 else (float(i % 7), float(i % 11))
    rows = [(i // 2, *pair(i), "own") for i in range(24_000)]
    table = [(i, j, i * 100.0 + j, "other") for i in range(6) for j in range(9)]
    r = spark.createDataFrame(rows, "id long, home double, work double, note string")
    t = spark.createDataFrame(table, "orig long, dest long, time double, note string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = relations.pair_lookup(r, t, {"home": "orig", "work": "dest"})
        sizes = [x["count"] for x in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        got = sorted(map(tuple, out.collect()), key=repr)
        empty = relations.pair_lookup(r.limit(0), t, {"home": "orig", "work": "dest"})
        assert empty.columns == ["id", "home", "work", "note", "time"] and empty.isEmpty()
        assert relations.pair_lookup(r, t.limit(0), {"home": "orig", "work": "dest"}).where("time is not null").isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    times = {(i, j): v for i, j, v, _ in table}
    assert got == sorted([(i, h, w, n, times.get((h, w))) for i, h, w, n in rows], key=repr)
    assert max(sizes) < 24_000 / 8 * 2


def test_pair_lookup_leaves_out_table_rows_that_no_row_asks_for(spark):
    from dayplan.operators import relations

    table = spark.range(200).selectExpr("cast(id as double) as home").crossJoin(spark.range(100).selectExpr("id as work"))
    table = table.selectExpr("home", "work", "home * 100 + work as time")
    asked = [(float(i % 200), i % 7) for i in range(300)] + [(-0.0, 3), (None, 1), (5.0, None), (900.0, 1)]
    rows = spark.createDataFrame(asked, "home double, work long")
    left = {(r["home"], r["work"]) for r in relations._wanted(table, rows.where("home is not null and work is not null"), ["home", "work"], len(asked)).collect()}
    wanted = {(h, w) for h, w in asked if h is not None and w is not None and h < 200}
    assert wanted <= left and len(left) < 3 * len(wanted)  # of 20,000
    got = relations.pair_lookup(rows, table, {"home": "home", "work": "work"}).collect()
    assert sorted((repr(r["home"]), repr(r["work"]), r["time"]) for r in got if r["time"] is not None) == sorted(
        (repr(h), repr(w), h * 100 + w + 0.0) for h, w in asked if (h, w) in wanted)
    assert len(got) == len(asked)


def test_round_trips_leave_out_zone_pairs_that_nobody_asks_for_before_they_meet(spark):
    from dayplan.operators import relations
    from dayplan.operators.skims import round_trip_times

    mtc = [(o, d, 10.0 * o + d) for o in range(40) for d in range(40) if (o, d) != (4, 3)] + [(5, 6, 1000.0), (6, 5, 2000.0)]
    t = spark.createDataFrame(mtc, "orig long, dest long, da_Time_AM double")
    asked = [(1, 3.0, 4.0), (2, 5.0, 6.0), (3, 7.0, 7.0), (4, None, 2.0), (5, 4.0, 3.0), (6, 900.0, 1.0), (7, 3.0, 4.0)]
    rows = spark.createDataFrame(asked, "id long, home double, work double")
    on, met = {"home": "orig", "work": "dest"}, []

    def times(wanted):
        met.extend([wanted(t).count(), wanted(t.selectExpr("dest as orig", "orig as dest")).count()])
        return round_trip_times(t, ("AM",), wanted)

    got = [tuple(r) for r in relations.pair_lookup(rows, times, on).collect()]
    whole = [tuple(r) for r in relations.pair_lookup(rows, round_trip_times(t, ("AM",)), on).collect()]
    assert sorted(got, key=repr) == sorted(whole, key=repr) and len(got) == len(asked) + 3  # repeated pairs stay repeated
    assert {r[3] for r in got if r[0] == 2} == {56.0 + 65.0, 1000.0 + 65.0, 56.0 + 2000.0, 1000.0 + 2000.0}
    assert all(2 < n < 40 for n in met)  # of 1,601
