"""Skim tables: cheap measures, reading of many columns, imputation by one join; tasks of the nearest-node search."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from checks.registry import as_text
from dayplan.operators import network
from dayplan.operators.skims import METERS_PER_MILE, impute_skims, mode_rates, morning_cells
from dayplan.session import Scratch, task_count
from dayplan.sources.readers import conform


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_measures_are_the_decimal_sums_without_decimals(spark):
    pairs = spark.createDataFrame([(a, b) for a in (1, 2, 7, 359_999) for b in (1, 3, 100, 360_000)] + [(None, 4)], "orig long, dest long")
    texts = [fixtures._skim_columns(d) for d in (fixtures.Spark, fixtures.Duck)]
    ours, theirs = (spark.sql(f"SELECT p.orig, p.dest, {t} FROM {{pairs}} p", pairs=pairs) for t in texts)
    assert "decimal" not in plan(ours).lower()
    assert ours.schema == theirs.schema
    assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))


def test_wide_text_is_read_outside_of_the_fused_method(spark):
    rows = spark.range(50).select(
        F.col("id").alias("orig"), F.col("id").alias("dest"), *[(F.col("id") / (i + 3)).alias(f"da_Time_{i}") for i in range(70)])
    read = conform(as_text(rows), "mtc_skims")
    parsing = [line for line in plan(read).splitlines() if "da_Time_5" in line and "cast(" in line]
    assert parsing and not any("*(" in line for line in parsing)
    assert read.dtypes == rows.dtypes
    assert sorted(read.collect()) == sorted(rows.collect())
    broken = as_text(rows.limit(1)).withColumns({"da_Time_0": F.lit("x"), "da_Time_1": F.lit(None).cast("string")})
    assert conform(broken, "mtc_skims").first()[2:4] == (None, None)


RAW = "from_zone_id long, to_zone_id long, mode string, hour long, generalizedTimeInS double, gen_cost double, distanceInM double, numObservations long"


def test_imputation_is_a_projection_with_the_rates_of_all_observations(spark):
    # a pair twice in the grid, one beside it, one without a zone, one without a distance
    grid = spark.createDataFrame(
        [(1, 1, 1.0), (1, 2, 3.0), (1, 2, 3.0), (2, 1, 2.0), (None, 2, 4.0), (2, 2, None)],
        "orig long, dest long, da_distance_AM double")
    seen = spark.createDataFrame([
        (1, 2, "CAR", 8, 600.0, 2.0, 5000.0, 2), (1, 1, "CAR", 7, 60.0, 1.0, 900.0, 1), (7, 9, "CAR", 8, 90.0, 3.0, 800.0, 1),
        (None, 2, "CAR", 9, 300.0, 4.0, 700.0, 3), (2, 2, "CAR", 9, 30.0, 4.0, 0.0, 3), (2, 1, "CAR", 12, 1.0, 1.0, 1.0, 5),
        (1, 2, None, 8, 50.0, 5.0, 50.0, 1), (2, 1, "BIKE", 8, None, 5.0, 60.0, 1), (1, 2, "BIKE", 8, 70.0, 6.0, 0.0, 4)], RAW)
    rates = {r["mode"]: r for r in mode_rates(morning_cells(seen), grid).collect()}
    got = impute_skims(grid, seen)
    assert "Exchange" not in plan(got) and "Join" not in plan(got)
    rows = got.collect()
    assert len(rows) == 6 and sum((r["from_zone_id"], r["to_zone_id"]) == (1, 2) for r in rows) == 2
    by_pair = {(r["from_zone_id"], r["to_zone_id"]): r for r in rows}
    assert by_pair[1, 2]["gen_tt_CAR"] == pytest.approx(10) and by_pair[2, 2]["gen_tt_CAR"] == pytest.approx(0.5)
    assert by_pair[2, 1]["gen_tt_CAR"] == pytest.approx(2 * METERS_PER_MILE * rates["CAR"]["gen_time_per_m"])
    assert by_pair[None, 2]["gen_cost_CAR"] == pytest.approx(4 * METERS_PER_MILE * rates["CAR"]["gen_cost_per_m"])
    assert by_pair[1, 1]["gen_tt_BIKE"] == pytest.approx(METERS_PER_MILE * rates["BIKE"]["gen_time_per_m"])
    assert by_pair[2, 2]["gen_tt_BIKE"] is None


def test_imputation_without_observations(spark):
    grid = spark.createDataFrame([(1, 1, 1.0)], "orig long, dest long, da_distance_AM double")
    got = impute_skims(grid, spark.createDataFrame([], RAW), ["CAR"]).collect()
    assert [tuple(r) for r in got] == [(1, 1, METERS_PER_MILE, None, None)]


def test_a_kept_model_table_is_made_once(spark, folder):
    model = fixtures.Model(spark, folder)
    want = model["jobs"].count()
    model.keep("jobs")
    stored = model["jobs"]
    model.keep("jobs")
    assert model["jobs"] is stored and stored.count() == want and "Aggregate" not in plan(stored)


def test_search_has_no_task_for_each_small_tile(spark, monkeypatch):
    nodes = spark.range(4000).select(F.col("id").alias("osmid"), (F.col("id") % 64 / 64).alias("x"), (F.col("id") / 4000).alias("y"))
    monkeypatch.setattr(network, "TILE", 16)
    net, tiles = network._tiled(nodes, Scratch(spark, "nearest"))
    points = spark.range(100).select(
        F.col("id").alias("_key"), F.lit(0.5).alias("_x"), F.lit(0.5).alias("_y"), F.lit(int(tiles.code[0])).alias("_tile"))
    assert len(tiles.code) > 8 * task_count(spark)
    assert network._searched(points, 100, net, tiles, True).rdd.getNumPartitions() <= task_count(spark)
