"""Skim imputation and street networks against brute force on small inputs."""

import math
import random

import numpy as np
import pytest

from dayplan.operators import network
from dayplan.operators.network import nearest_node, network_aggregate, reach_median, reachable
from dayplan.operators.skims import (
    SkimVariable,
    fix_distances,
    impute_skims,
    mode_rates,
    morning_cells,
    period_columns,
    round_trip_times,
    skim_access,
    skims_by_period,
)
from dayplan.session import Scratch
from dayplan.specs.network import NetworkVariable

RAW = (
    "from_zone_id long, to_zone_id long, mode string, hour long, generalizedTimeInS double, gen_cost double, "
    "distanceInM double, numObservations long"
)


def brute_impute(mtc, raw):
    """Row repetition, plain loops."""
    dist = {(o, d): miles * 1609.34 for o, d, miles in mtc}
    rates, cells = {}, {}
    for o, d, mode, hour, sec, cost, meters, n in raw:
        if hour not in (7, 8, 9):
            continue
        if meters == 0 or o == d:
            meters = dist.get((o, d))
        for _ in range(n):
            cells.setdefault((o, d, mode), []).append((sec / 60 if sec is not None else None, cost))
            if meters and sec is not None and cost is not None:
                rates.setdefault(mode, []).append((sec / 60 / meters, cost / meters))
    rate = {m: np.mean(v, axis=0) for m, v in rates.items()}
    out = {}
    for pair, meters in dist.items():
        row = {"dist": meters}
        for mode in sorted({k[2] for k in cells}):
            seen = cells.get((*pair, mode), [])
            for i, name in enumerate(("gen_tt", "gen_cost")):
                known = [s[i] for s in seen if s[i] is not None]
                row[f"{name}_{mode}"] = (
                    np.mean(known) if known else meters * rate[mode][i] if mode in rate else None
                )
        out[pair] = row
    return out


@pytest.fixture(scope="module")
def skim_data():
    rng = random.Random(11)
    zones = range(1, 7)
    mtc = [(o, d, 0.5 + abs(o - d)) for o in zones for d in zones]
    raw = []
    for _ in range(400):
        raw.append((
            rng.choice([1, 1, 1, rng.randint(1, 6)]), rng.choice([2, 2, rng.randint(1, 7)]),
            rng.choice(["CAR", "WALK_TRANSIT"]), rng.randint(6, 10),
            rng.choice([None, 60.0 * rng.random() * 20 + 1]), rng.choice([None, 0.0, rng.random() * 9]),
            rng.choice([0.0, 1000.0 * rng.random() + 1]), rng.randint(0, 3),
        ))
    # a mode seen only without usable rates stays unknown where it was not observed
    raw.append((1, 2, "FERRY", 8, 600.0, None, 500.0, 1))
    return mtc, raw


def test_imputed_skims_match_brute_force(spark, skim_data):
    mtc, raw = skim_data
    grid = spark.createDataFrame(mtc, "orig long, dest long, da_distance_AM double")
    seen = spark.createDataFrame(raw, RAW).repartition(5)
    want = brute_impute(mtc, raw)
    got = impute_skims(grid, seen).collect()
    assert len(got) == len(mtc)
    for r in got:
        for name, value in want[(r["from_zone_id"], r["to_zone_id"])].items():
            assert (r[name] is None) == (value is None), name
            assert value is None or r[name] == pytest.approx(value, rel=1e-12), name


def test_missing_pair_gives_unknown_distance_not_an_error(spark):
    grid = spark.createDataFrame([(1, 1, 1.0)], "orig long, dest long, da_distance_AM double")
    seen = spark.createDataFrame(
        [(1, 9, "CAR", 8, 600.0, 1.0, 0.0, 1), (1, 1, "CAR", 8, 600.0, 2.0, 7.0, 1)], RAW
    )
    fixed = {r["to_zone_id"]: r["distanceInM"] for r in fix_distances(seen, grid).collect()}
    assert fixed == {9: None, 1: 1609.34}
    rates = mode_rates(morning_cells(seen), grid).collect()
    assert rates[0]["gen_time_per_m"] == pytest.approx(10 / 1609.34)


def test_access_is_strict_adds_own_zone_and_covers_all_zones(spark):
    zones = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 40.0)], "zone_id long, v double")
    skims = spark.createDataFrame(
        [(1, 1, 1.0), (1, 2, 5.0), (1, 3, 15.0), (2, 3, 4.0), (2, 1, None)],
        "from_zone_id long, to_zone_id long, t double",
    )
    specs = [SkimVariable("s", "v", "t", 15), SkimVariable("m", "v", "t", 15, "mean"),
             SkimVariable("l", "v", "t", 15, log=True)]
    rows = {r["zone_id"]: r for r in skim_access(zones, skims, specs).collect()}
    assert (rows[1]["s"], rows[2]["s"], rows[3]["s"]) == (10 + 20 + 10, 40 + 20, 0 + 40)
    assert (rows[1]["m"], rows[3]["m"]) == (15 + 10, 40)
    assert rows[2]["l"] == pytest.approx(math.log1p(60))


def test_period_columns_match_by_ending():
    names = ["da_Time_AM", "da_distance_AM", "AM_extra_EA", "da_cost_MD"]
    assert period_columns(names, "AM") == {"da_Time_AM": "da_Time", "da_distance_AM": "da_Distance"}
    assert period_columns(names, "MD") == {"da_cost_MD": "da_Cost"}


def test_period_table_and_round_trips(spark):
    mtc = spark.createDataFrame(
        [(1, 2, 10.0, 20.0, 1.0), (2, 1, 30.0, 40.0, 2.0)],
        "orig long, dest long, da_Time_AM double, da_Time_MD double, da_distance_AM double",
    )
    rows = {(r["orig"], r["TOD"]): r for r in skims_by_period(mtc, ("AM", "MD")).collect()}
    assert rows[(1, "AM")]["da_Distance"] == 1.0 and rows[(1, "MD")]["da_Distance"] is None
    trips = {r["orig"]: r for r in round_trip_times(mtc, ("AM", "MD")).collect()}
    assert trips[1]["da_Time_AM_MD"] == 10 + 40 and trips[2]["da_Time_MD_AM"] == 40 + 10


# ---------------------------------------------------------------- networks


@pytest.fixture(scope="module")
def graph():
    rng = random.Random(5)
    n = 24
    edges = [(rng.randrange(n), rng.randrange(n), float(rng.randint(1, 40))) for _ in range(70)]
    edges += [(0, 1, 5.0), (0, 1, 3.0), (2, 2, 1.0), (3, 4, 999.0)]  # parallel, loop, too long
    return n, edges


def shortest(n, edges, radius, twoway):
    d = np.full((n, n), np.inf)
    np.fill_diagonal(d, 0)
    for a, b, w in edges:
        d[a, b] = min(d[a, b], w)
        if twoway:
            d[b, a] = min(d[b, a], w)
    for k in range(n):
        d = np.minimum(d, d[:, [k]] + d[[k], :])
    return {(i, j): d[i, j] for i in range(n) for j in range(n) if d[i, j] <= radius}


@pytest.mark.parametrize("twoway,hops", [(False, 1), (True, 2), (True, 4), (False, 8)])
def test_reach_matches_all_pairs_shortest_paths(spark, graph, twoway, hops):
    n, edges = graph
    nodes = spark.createDataFrame([(i,) for i in range(n)], "osmid long")
    e = spark.createDataFrame(edges, "u long, v long, length double")
    got = {(r["src"], r["dst"]): r["dist"] for r in reachable(nodes, e, 60, twoway, hops=hops).collect()}
    want = shortest(n, edges, 60, twoway)
    assert got == want
    if twoway:
        assert all(got[(b, a)] == d for (a, b), d in got.items())


def test_reach_of_some_sources(spark, graph):
    n, edges = graph
    nodes = spark.createDataFrame([(i,) for i in range(n)], "osmid long")
    e = spark.createDataFrame(edges, "u long, v long, length double")
    got = {(r["src"], r["dst"]) for r in reachable(nodes, e, 60, False, nodes.where("osmid < 3")).collect()}
    assert got == {p for p in shortest(n, edges, 60, False) if p[0] < 3}


def test_variables_match_direct_aggregation(spark, graph):
    n, edges = graph
    rng = random.Random(9)
    facts = [(rng.choice([None, 0, 0, 0, rng.randrange(n)]), rng.choice([None, float(rng.randint(1, 9))]),
              rng.randint(0, 1)) for _ in range(300)]
    nodes = spark.createDataFrame([(i,) for i in range(n)], "osmid long")
    e = spark.createDataFrame(edges, "u long, v long, length double")
    table = spark.createDataFrame(facts, "node long, value double, kind int")
    specs = [
        NetworkVariable("n_all", "t", None, None, 60, "sum"),
        NetworkVariable("s_near", "t", "value", "kind = 1", 20, "sum"),
        NetworkVariable("a_far", "t", "value", None, 60, "ave"),
        NetworkVariable("m_far", "t", "value", "kind = 0", 60, "median"),
    ]
    reach = reachable(nodes, e, 60, True)
    got = {r["osmid"]: r for r in network_aggregate(reach, {"t": table}, "node", specs).collect()}
    pairs = shortest(n, edges, 60, True)
    for i in range(n):
        far = [f for f in facts if f[0] is not None and (i, f[0]) in pairs]
        near = [f for f in far if pairs[(i, f[0])] <= 20]
        known = [f[1] for f in far if f[1] is not None]
        zero = [f[1] for f in far if f[1] is not None and f[2] == 0]
        assert got[i]["n_all"] == len(far)
        assert got[i]["s_near"] == sum(f[1] for f in near if f[1] is not None and f[2] == 1)
        assert got[i]["a_far"] == pytest.approx(np.mean(known) if known else 0.0)
        assert got[i]["m_far"] == (np.median(zero) if zero else 0.0)


@pytest.mark.parametrize("digit", [2, 3, 256])
def test_reach_median_by_digits(spark, digit):
    rng = random.Random(digit)
    values = [(rng.choice([1, 1, 1, 2, 3]), round(rng.random() * 50) / 2) for _ in range(200)]
    pairs = [(10, 1), (10, 2), (11, 3), (12, 1), (12, 2), (12, 3), (13, 4)]
    reach = spark.createDataFrame(pairs, "src long, dst long")
    table = spark.createDataFrame(values, "node long, value double")
    got = {r["src"]: r["median"] for r in reach_median(reach, table, digit).collect()}
    want = {}
    for s, d in pairs:
        want.setdefault(s, []).extend(v for n, v in values if n == d)
    assert got == {s: float(np.median(v)) for s, v in want.items() if v}


def test_nearest_node_matches_brute_force(spark):
    rng = random.Random(21)
    nodes = [(i, rng.random(), rng.random()) for i in range(80)]
    nodes += [(100 + i, 0.5 + 1e-4 * rng.random(), 0.5) for i in range(40)]  # a dense spot
    nodes += [(7, 3.0, 3.0), (300, nodes[0][1], nodes[0][2])]  # far node, equal coordinates
    nodes = [n for i, n in enumerate(nodes) if n[0] != 7 or i > 50]
    points = [(i, rng.random() * 1.2 - 0.1, rng.random() * 1.2 - 0.1) for i in range(200)]
    points += [(500, 40.0, -30.0), (501, None, 1.0), (502, nodes[0][1], nodes[0][2])]
    p = spark.createDataFrame(points, "id long, x double, y double")
    net = spark.createDataFrame(nodes, "osmid long, x double, y double")
    got = {r["id"]: r["node_id"] for r in nearest_node(p, net, "id", "x", "y").collect()}
    for i, x, y in points:
        want = None if x is None else min(((x - a) ** 2 + (y - b) ** 2, n) for n, a, b in nodes)[1]
        assert got[i] == want, i


def test_nearest_node_takes_as_many_jobs_for_far_points(spark):
    rng = random.Random(22)
    nodes = [(i, rng.random(), rng.random()) for i in range(300)] + [(900 + i, 40 + rng.random(), 40.0) for i in range(60)]
    net = spark.createDataFrame(nodes, "osmid long, x double, y double")
    jobs = []
    for width in (60.0, 1e6):
        points = [(i, (rng.random() - 0.5) * width, (rng.random() - 0.5) * width) for i in range(150)]
        points += [(i, rng.random() * 50 - 5, rng.random() * 50 - 5) for i in range(150, 300)]
        p = spark.createDataFrame(points, "id long, x double, y double")
        spark.sparkContext.setJobGroup(f"near-{width}", "nearest")
        found = {r["id"]: r["node_id"] for r in nearest_node(p, net, "id", "x", "y").collect()}
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"near-{width}")))
        assert found == {i: min(((x - a) ** 2 + (y - b) ** 2, n) for n, a, b in nodes)[1] for i, x, y in points}
    spark.sparkContext.setJobGroup("", "")
    assert abs(jobs[0] - jobs[1]) <= 2


def test_nearest_node_unknown_coordinates(spark):
    nan, inf = float("nan"), float("inf")
    nodes = [(i, i * 0.1, 0.0) for i in range(40)] + [(90, nan, 0.0), (91, 0.0, inf), (92, None, 0.0)]
    points = [(1, 0.11, 0.0), (2, nan, 0.0), (3, 0.0, -inf), (4, None, None)]
    p = spark.createDataFrame(points, "id long, x double, y double")
    net = spark.createDataFrame(nodes, "osmid long, x double, y double")
    got = {r["id"]: r["node_id"] for r in nearest_node(p, net, "id", "x", "y").collect()}
    assert got == {1: 1, 2: None, 3: None, 4: None}


def test_nearest_node_meets_few_nodes_of_uneven_networks(spark):
    """Columns of nodes far closer within a column than columns are apart: one grid fits neither."""
    rng = np.random.default_rng(5)
    nodes = [(i, (i % 5) / 5, (i // 5) / 1200) for i in range(6000)]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((400, 2)))]
    points += [(400, 40.0, 0.5), (401, -3.0, -7.0), (402, 0.3, 0.5)]  # far away, and between two columns
    net = spark.createDataFrame(nodes, "osmid long, x double, y double")
    p = spark.createDataFrame(points, "id long, px double, py double")
    xs, ys = np.array([n[1] for n in nodes]), np.array([n[2] for n in nodes])
    want = {i: int(((x - xs) ** 2 + (y - ys) ** 2).argmin()) for i, x, y in points}
    found = nearest_node(p, net, "id", "px", "py")
    assert {r["id"]: r["node_id"] for r in found.collect()} == want
    placed, tiles = network._tiled(net, Scratch(spark, "test"))
    sizes = [r["count"] for r in placed.groupBy("_tile").count().collect()]
    assert sum(sizes) == len(nodes) and max(sizes) <= network.TILE
    rows = spark.createDataFrame(points, "_key long, _x double, _y double")
    at_home = rows.mapInArrow(tiles.place, "_key long, _x double, _y double, _tile long")
    visits = network._searched(at_home, len(points), placed, tiles, True).selectExpr("sum(1 + size(more)) n").first()["n"]
    assert visits < 3 * len(points)


def test_nearest_node_deals_out_points_of_one_tile(spark, monkeypatch):
    monkeypatch.setattr(network, "PART_POINTS", 50)
    net = spark.createDataFrame([(7, 0.0, 0.0), (3, 1.0, 0.0), (5, None, 0.0)], "osmid long, x double, y double")
    p = spark.range(400).selectExpr("cast(id as string) as id", "id / 400D as px", "0D as py")
    got = {r["id"]: r["node_id"] for r in nearest_node(p.unionByName(p), net, "id", "px", "py").collect()}
    assert got == {str(i): 7 if i < 200 else 3 for i in range(400)}


def test_nearest_node_stores_no_place_of_settled_points(spark, monkeypatch):
    rng = random.Random(31)
    nodes = [(i, float(i % 60), float(i // 60)) for i in range(3600)]
    points = [(i, rng.random() * 59, rng.random() * 59) for i in range(300)] + [(900, 1.25, 1.25)] * 3 + [(900, 50.25, 50.25)]
    p = spark.createDataFrame(points, "id long, x double, y double").repartition(4)
    net = spark.createDataFrame(nodes, "osmid long, x double, y double")
    stored, write = {}, Scratch.write_counting

    def keep(self, df, name, condition="true"):
        out = write(self, df, name, condition)
        stored[name] = out[0]
        return out

    monkeypatch.setattr(Scratch, "write_counting", keep)
    got = sorted(tuple(r) for r in nearest_node(p, net, "id", "x", "y").collect())
    assert got == sorted((i, min(((x - a) ** 2 + (y - b) ** 2, n) for n, a, b in nodes)[1]) for i, x, y in set(points))
    hits = stored["hits"]
    assert 0 < hits.where("_x is not null").count() < hits.count() == len(set(points))
