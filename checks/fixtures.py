"""Model tables derived from the given parquet tables, in Spark SQL and in DuckDB SQL.

Both engines get the same definitions; only a few words differ (uniform draws, string
type, row expansion). Every supplier is a zone, and the pair table holds the zone pairs
that occur, so all tables grow with the data and none is squared.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from dayplan.session import materialize

ZONE_COUNT = "(SELECT count(*) FROM {supplier})"
BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
SECTOR_CODES = (44, 45, 62, 51, 54, 72, 31, 32, 33, 61, 81, 23, 92, 52, 53, 42, 56, 48, 71, 22, 11)
SKIM_MEASURES = {
    "da": ("Time", "cost", "distance"),
    "s2": ("Time", "cost", "distance"),
    "wTrnW": ("Time", "cost"),
    "dTrnW": ("Time", "cost"),
    "wTrnD": ("Time", "cost"),
    "bike": ("Time", "distance"),
    "walk": ("Time", "distance"),
}
INDICATORS = (
    "average_income_20", "above_jobs_20", "above_jobs_40", "above_jobs_60", "below_jobs_20",
    "below_jobs_40", "below_jobs_60", "employment_20", "employment_40", "employment_60",
    "population_20", "population_40", "population_60",
)


class Spark:
    text = "STRING"

    @staticmethod
    def u(salt: str, key: str) -> str:
        return (
            f"(CAST(conv(substring(md5(concat_ws('|','{salt}',CAST({key} AS STRING))),1,8),16,10) "
            "AS BIGINT) / 4294967296.0D)"
        )

    @staticmethod
    def expand(last: str) -> str:
        return f"explode(sequence(CAST(1 AS BIGINT), {last}))"

    @staticmethod
    def hundredths(start: str, far: str, slope: str, more: str | None = None) -> str:
        """``start + far * slope + more`` in whole hundredths: one division of whole numbers, which ends at the
        double next to the decimal sum, without a decimal number per value."""
        whole = [f"{int(Decimal(start) * 100)}L", f"{far} * {int(Decimal(slope) * 100)}L"]
        whole += [f"({more}) * 100L"] if more else []
        return f"({' + '.join(whole)}) / 100.0D"


class Duck:
    text = "VARCHAR"

    @staticmethod
    def u(salt: str, key: str) -> str:
        return (
            f"(CAST('0x' || substr(md5('{salt}|' || CAST({key} AS VARCHAR)),1,8) AS BIGINT) / "
            "CAST(4294967296 AS DOUBLE))"
        )

    @staticmethod
    def expand(last: str) -> str:
        return f"unnest(range(CAST(1 AS BIGINT), {last} + 1))"

    @staticmethod
    def hundredths(start: str, far: str, slope: str, more: str | None = None) -> str:
        return f"CAST({start} + {far} * {slope}{f' + {more}' if more else ''} AS DOUBLE)"


def _skim_columns(d) -> str:
    out = []
    for m, (mode, measures) in enumerate(SKIM_MEASURES.items()):
        for measure in measures:
            for p, period in enumerate(("EA", "AM", "MD", "PM", "EV")):
                far = "abs(p.orig - p.dest)"
                if measure == "Time":
                    slope = f"{0.11 + 0.02 * p + 0.03 * m:.2f}"
                    value = d.hundredths("2", far, slope, "((p.orig - 1) * 7 + (p.dest - 1) * 3) % 5")
                elif measure == "cost":
                    value = d.hundredths(f"{25 * (m + 1)}", far, f"{1.5 + 0.25 * p + 0.5 * m:.2f}")
                else:
                    value = d.hundredths("0.1", far, f"{0.05 + 0.01 * m:.2f}")
                out.append(f"{value} AS {mode}_{measure}_{period}")
    return ", ".join(out)


def _skim_pairs(zc: str) -> str:
    """The zone pairs that trips or commuters use, and every zone with itself."""
    return (
        "SELECT orig, dest FROM ("
        "SELECT zone_id AS orig, zone_id AS dest FROM {zones} UNION ALL "
        f"SELECT l_suppkey % {zc} + 1, o_custkey % {zc} + 1 FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey "
        "UNION ALL SELECT hp.zone_id, jp.zone_id FROM {persons} p JOIN {persons_work} w ON w.person_id = p.person_id "
        "JOIN {households} h ON h.household_id = p.household_id JOIN {buildings} hb ON hb.building_id = h.building_id "
        "JOIN {parcels} hp ON hp.parcel_id = hb.parcel_id JOIN {jobs} j ON j.job_id = w.job_id "
        "JOIN {buildings} jb ON jb.building_id = j.building_id JOIN {parcels} jp ON jp.parcel_id = jb.parcel_id"
        ") x GROUP BY orig, dest"
    )


def definitions(d) -> dict[str, str]:
    """Table name to SQL; {name} stands for a base or an earlier table."""
    u, s = d.u, d.text
    zc = ZONE_COUNT
    np_ = "(SELECT count(*) FROM {part})"
    nr = "(SELECT ceil(count(*) / CAST(50 AS DOUBLE)) FROM {part})"
    dbl = "CAST({} AS DOUBLE)".format
    case = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(SECTOR_CODES))
    block = f"lpad(CAST((p_partkey - p_partkey % 4) * 37 AS {s}), 15, '0')"
    indicators = ", ".join(
        f"CASE WHEN {u('n' + str(i), 'block_id')} < 0.1 THEN NULL ELSE "
        f"CAST(floor({u('v' + str(i), 'block_id')} * {100000 - 5000 * i}) AS DOUBLE) END AS {name}"
        for i, name in enumerate(INDICATORS)
    )
    return {
        "zones": f"SELECT DISTINCT s_suppkey % {zc} + 1 AS zone_id FROM {{supplier}}",
        "parcels": f"SELECT p_partkey AS parcel_id, p_partkey % {zc} + 1 AS zone_id, "
        f"{u('px', 'p_partkey')} AS x, {u('py', 'p_partkey')} AS y, {block} AS block_id FROM {{part}}",
        "buildings": "SELECT p_partkey AS building_id, p_partkey - p_partkey % 2 AS parcel_id, "
        "CAST(1 + p_partkey % 3 AS BIGINT) AS building_type_id, "
        "CAST(p_size % 12 AS DOUBLE) AS residential_units, "
        "CASE WHEN p_size % 8 = 0 THEN CAST(0 AS DOUBLE) "
        "ELSE CAST(floor(p_retailprice) * p_size AS DOUBLE) END AS residential_sqft, "
        "CAST(floor(p_retailprice) AS DOUBLE) AS sqft_per_unit FROM {part}",
        "units": "SELECT building_id * 12 + i - 1 AS unit_id, building_id FROM (SELECT p_partkey AS "
        f"building_id, {d.expand('CAST(p_size % 12 AS BIGINT)')} AS i FROM {{part}} "
        "WHERE p_size % 12 > 0) n",
        "households": "SELECT household_id, building_id, building_id * 12 + household_id % 3 AS unit_id, "
        "income, persons, tenure, race_of_head, hispanic_head, age_of_head, children, workers, "
        "single_family, building_type, cars FROM (SELECT c_custkey AS household_id, "
        f"CAST(floor({u('hb', 'c_custkey')} * {np_}) AS BIGINT) AS building_id, "
        "CAST(floor((c_acctbal + 1000) * 20) AS DOUBLE) AS income, "
        "CAST(1 + c_custkey % 6 AS DOUBLE) AS persons, CAST(1 + c_nationkey % 4 AS BIGINT) AS tenure, "
        f"CAST(1 + floor({u('hr', 'c_custkey')} * 9) AS BIGINT) AS race_of_head, "
        f"CASE WHEN {u('hh', 'c_custkey')} < 0.2 THEN 'yes' ELSE 'no' END AS hispanic_head, "
        f"CAST(20 + floor({u('ha', 'c_custkey')} * 70) AS BIGINT) AS age_of_head, "
        f"CAST(floor({u('hc', 'c_custkey')} * 4) AS BIGINT) AS children, "
        "CAST(c_custkey % 3 AS BIGINT) AS workers, CAST(c_custkey % 2 AS BIGINT) AS single_family, "
        "CAST(1 + c_custkey % 3 AS BIGINT) AS building_type, CAST(c_custkey % 4 AS BIGINT) AS cars "
        "FROM {customer}) h",
        "persons": "SELECT o_orderkey AS person_id, o_custkey AS household_id, "
        f"CAST(floor({u('pa', 'o_orderkey')} * 95) AS BIGINT) AS age, "
        "CAST(1 + o_orderkey % 2 AS BIGINT) AS sex, "
        f"CAST(1 + floor({u('pr', 'o_orderkey')} * 9) AS BIGINT) AS race_id, "
        f"CAST(floor({u('pe', 'o_orderkey')} * 25) AS BIGINT) AS edu, "
        f"CAST(CASE WHEN {u('pw', 'o_orderkey')} < 0.6 THEN 1 ELSE 0 END AS BIGINT) AS worker, "
        f"CAST(CASE WHEN {u('ph', 'o_orderkey')} < 0.1 THEN 1 ELSE 0 END AS BIGINT) AS work_at_home, "
        f"CAST(10 + floor({u('pq', 'o_orderkey')} * 50) AS BIGINT) AS hours FROM {{orders}}",
        "jobs": "SELECT job_id, building_id, CAST(CASE CAST(floor("
        f"{u('js', 'job_id')} * 21) AS BIGINT) {case} END AS BIGINT) AS sector_id FROM ("
        "SELECT l_orderkey * 8 + l_linenumber AS job_id, min(l_partkey) AS building_id "
        "FROM {lineitem} GROUP BY l_orderkey, l_linenumber) j",
        # persons with a job that may not exist, and a time-of-day code
        "persons_work": f"SELECT o_orderkey AS person_id, o_orderkey * 8 + CAST(1 + floor("
        f"{u('wj', 'o_orderkey')} * 7) AS BIGINT) AS job_id, CAST(CASE CAST(floor("
        f"{u('wt', 'o_orderkey')} * 8) AS BIGINT) WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 12 "
        "WHEN 3 THEN 13 WHEN 4 THEN 14 WHEN 5 THEN 22 WHEN 6 THEN 23 ELSE 24 END AS BIGINT) AS TOD "
        "FROM {orders}",
        "establishments": "SELECT s_suppkey AS establishment_id, "
        f"CAST(floor({u('eb', 's_suppkey')} * {np_}) AS BIGINT) AS building_id, "
        "s_suppkey * 10 AS primary_id FROM {supplier}",
        # whole rents and areas: their sums are exact, so averages agree to the last bit
        "rentals": "SELECT o_orderkey AS pid, "
        f"CASE WHEN {u('rn', 'o_orderkey')} < 0.05 THEN NULL ELSE CAST(floor(o_totalprice / 30) AS DOUBLE) END AS rent, "
        f"o_totalprice / 30 / (400 + floor({u('rs', 'o_orderkey')} * 1600)) AS rent_sqft, "
        f"{u('rx', 'o_orderkey')} AS longitude, {u('ry', 'o_orderkey')} AS latitude FROM {{orders}}",
        # the pairs that trips or commuters use, and every zone with itself
        "mtc_skims": f"SELECT p.orig, p.dest, {_skim_columns(d)} FROM ({_skim_pairs(zc)}) p",
        "beam_skims_raw": f"SELECT l_suppkey % {zc} + 1 AS origTaz, o_custkey % {zc} + 1 AS destTaz, "
        "CASE l_returnflag WHEN 'R' THEN 'CAR' WHEN 'N' THEN 'WALK_TRANSIT' ELSE 'BIKE' END AS mode, "
        "CAST(6 + (l_orderkey + l_linenumber) % 5 AS BIGINT) AS hour, "
        "l_extendedprice / 20 AS generalizedTimeInS, l_tax * 100 AS generalizedCost, "
        "CASE WHEN l_quantity > 45 THEN CAST(0 AS DOUBLE) ELSE l_quantity * 1000 END AS distanceInM, "
        "CAST(l_linenumber % 4 AS BIGINT) AS numObservations "
        "FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey",
        "nodes": f"SELECT p_partkey AS osmid, (p_partkey % 50) / {dbl(50)} AS x, "
        f"floor(p_partkey / {dbl(50)}) / {nr} AS y FROM {{part}}",
        # a grid 50 nodes wide: one edge to the right (not at the end of a row), one up
        "edges": "SELECT p_partkey AS u, p_partkey + 1 AS v, CAST(50 + p_size * 10 AS DOUBLE) AS length "
        f"FROM {{part}} WHERE p_partkey % 50 < 49 AND p_partkey + 1 < {np_} "
        "UNION ALL SELECT p_partkey, p_partkey + 50, CAST(60 + p_size * 10 AS DOUBLE) "
        f"FROM {{part}} WHERE p_partkey + 50 < {np_}",
        # the blocks are numbered from another start than those of the parcels: some match nothing
        "access_indicators": f"SELECT block_id, {indicators} FROM (SELECT DISTINCT "
        f"CAST((p_partkey - p_partkey % 4) * 37 + 3700 AS {s}) AS block_id FROM {{part}}) b",
        # numbered from another start than the zones: the first zones match nothing
        "zone_accessibility": "SELECT zone_id + 3 AS taz1454, "
        + ", ".join(
            f"CAST(floor({u('z' + str(i), 'zone_id')} * 50000) AS DOUBLE) AS {c}"
            for i, c in enumerate(("da_15", "wTrnW_15", "bike_15", "walk_15"))
        )
        + " FROM {zones}",
        "survey_households": "SELECT c_custkey AS SAMPN, "
        f"CASE WHEN {u('si', 'c_custkey')} < 0.05 THEN CAST(98 AS BIGINT) "
        f"ELSE CAST(1 + floor({u('sj', 'c_custkey')} * 10) AS BIGINT) END AS INCOM FROM {{customer}}",
        "survey_persons": "SELECT o_orderkey AS obs_id, o_custkey AS SAMPN, "
        f"CAST(floor({u('sa', 'o_orderkey')} * 120) AS BIGINT) AS AGE, "
        f"CASE WHEN {u('se', 'o_orderkey')} < 0.05 THEN CAST(98 AS BIGINT) "
        f"ELSE CAST(1 + floor({u('sf', 'o_orderkey')} * 8) AS BIGINT) END AS EDUCA, "
        f"CASE WHEN {u('sn', 'o_orderkey')} < 0.1 THEN NULL ELSE o_orderkey * 8 + "
        f"CAST(1 + floor({u('sl', 'o_orderkey')} * 7) AS BIGINT) END AS job_id, "
        f"CAST(floor({u('sb', 'o_orderkey')} * {np_}) AS BIGINT) AS building_id FROM {{orders}}",
    }


_DUCK = definitions(Duck)
_SPARK = definitions(Spark)


def duck_ctes(names: list[str]) -> list[str]:
    """CTE texts of the named tables and of the tables they build on, as fx_<name>."""
    order = list(_DUCK)
    wanted: set[str] = set()

    def need(name: str) -> None:
        if name in wanted:
            return
        wanted.add(name)
        for other in order:
            if "{" + other + "}" in _DUCK[name]:
                need(other)

    for n in names:
        need(n)
    fill = {**{b: b for b in BASE}, **{n: f"fx_{n}" for n in order}}
    return [f"fx_{n} AS MATERIALIZED ({_DUCK[n].format(**fill)})" for n in order if n in wanted]


STORED: dict[str, str] = {}  # data folder: where ``store_model`` has put its model tables


def store_model(spark: SparkSession, folder: str, path: str) -> None:
    """Write all model tables of a data folder once; later models read them."""
    model = Model(spark, folder)
    for name in _SPARK:
        model[name].write.mode("overwrite").parquet(f"{path}/{name}")
        model._tables[name] = spark.read.parquet(f"{path}/{name}")
    STORED[folder] = path


class Model:
    """The model tables of one data folder as Spark DataFrames, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}
        self._kept: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            if name in BASE:
                self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            elif self.folder in STORED:
                self._tables[name] = self.spark.read.parquet(f"{STORED[self.folder]}/{name}")
            elif name == "mtc_skims":  # its pairs are stored once; the measures follow from them wherever it is read
                pairs = materialize(self._build(_skim_pairs(ZONE_COUNT)), "skim-pairs")
                self._tables[name] = self.spark.sql(f"SELECT p.orig, p.dest, {_skim_columns(Spark)} FROM {{pairs}} p", pairs=pairs)
            else:
                self._tables[name] = self._build(_SPARK[name])
        return self._tables[name]

    def _build(self, sql: str) -> DataFrame:
        needed = [t for t in (*BASE, *_SPARK) if "{" + t + "}" in sql]
        return self.spark.sql(sql, **{t: self[t] for t in needed})

    def keep(self, name: str) -> None:
        """Store a table that several steps read, so that it is made once."""
        if self.folder not in STORED and name not in self._kept:
            self._kept.add(name)
            self._tables[name] = materialize(self[name], f"model-{name}")

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}
