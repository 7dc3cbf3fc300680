"""Readers, derived columns, joins and totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import INDICATORS, Model
from checks.oracle import step
from checks.registry import as_text, query
from dayplan.operators.columns import (
    add_household_columns,
    add_job_columns,
    add_parcel_columns,
    add_person_columns,
)
from dayplan.operators.qa import profile
from dayplan.operators.relations import (
    add_zone_id_home,
    add_zone_id_work,
    complement,
    filter_all,
    merge_tables,
    update_column,
)
from dayplan.operators.zones import zone_avg_income, zone_totals
from dayplan.plans.modes import mode_persons
from dayplan.plans.survey import survey_observations
from dayplan.sources.readers import conform
from dayplan.specs.choice import WORKER_FILTERS
from dayplan.specs.recodes import INCOME_BINS, JOB_SECTORS, TOD_SECTORS


def round_all(columns, digits: int) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def dummy(condition: str, name: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS BIGINT) AS {name}"


# ---------------------------------------------------------------- readers


@query("q_read_parcels", "SELECT parcel_id, zone_id, x, y, block_id FROM fx_parcels")
def _(m: Model):
    return conform(as_text(m["parcels"]).withColumnRenamed("parcel_id", "primary_id"), "parcels")


@query(
    "q_buildings_sqft",
    "SELECT *, CASE WHEN residential_units = 0 AND residential_sqft > 0 THEN 0 "
    "WHEN residential_units = 0 THEN NULL ELSE residential_sqft / residential_units END "
    "AS res_sqft_per_unit FROM fx_buildings",
)
def _(m: Model):
    return conform(as_text(m["buildings"]), "buildings")


_ENTITIES = (
    ("jobs", "job_id", "building_id", "sector_id"),
    ("establishments", "establishment_id", "building_id", "primary_id"),
    ("households", "household_id", "building_id", "persons"),
    ("persons", "person_id", "household_id", "hours"),
    ("units", "unit_id", "building_id", "building_id"),
    ("zones", "zone_id", "zone_id", "zone_id"),
    ("walk_nodes", "osmid", "osmid", "y"),
    ("walk_edges", "uniqueid", "u", "length"),
    ("zone_accessibility", "taz1454", "taz1454", "da_15"),
)
_EDGE_KEY = "u * 2 + CASE WHEN v = u + 1 THEN 1 ELSE 0 END"


@query(
    "q_read_entities",
    " UNION ALL ".join(
        f"SELECT '{name}' AS entity, CAST({_EDGE_KEY if name == 'walk_edges' else key} AS BIGINT) AS id, "
        f"CAST({ref} AS BIGINT) AS ref, CAST({value} AS DOUBLE) AS amount "
        f"FROM fx_{ {'walk_nodes': 'nodes', 'walk_edges': 'edges'}.get(name, name)}"
        for name, key, ref, value in _ENTITIES
    ),
)
def _(m: Model):
    out = None
    for name, key, ref, value in _ENTITIES:
        raw = m[{"walk_nodes": "nodes", "walk_edges": "edges"}.get(name, name)]
        if name == "walk_edges":
            raw = raw.withColumn("uniqueid", F.expr(_EDGE_KEY))
        if name == "zones":
            raw = raw.withColumn("tract", F.lit("x"))
        text = as_text(raw)
        if name in ("jobs", "households", "persons"):
            text = text.withColumnRenamed(key, "Unnamed: 0")  # the first column is the key
        part = conform(text, name).select(
            F.lit(name).alias("entity"), F.col(key).alias("id"),
            F.col(ref).cast("bigint").alias("ref"), F.col(value).cast("double").alias("amount"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "q_read_skims",
    "SELECT origTaz AS from_zone_id, destTaz AS to_zone_id, mode, hour, generalizedTimeInS, "
    "generalizedCost AS gen_cost, distanceInM, numObservations FROM fx_beam_skims_raw",
)
def _(m: Model):
    return conform(as_text(m["beam_skims_raw"]), "beam_skims_raw")


@query(
    "q_rentals_clamped",
    "SELECT pid, CASE WHEN rent < 100 THEN 100 WHEN rent > 10000 THEN 10000 ELSE rent END AS rent, "
    "CASE WHEN rent_sqft < 0.2 THEN 0.2 WHEN rent_sqft > 50 THEN 50 ELSE rent_sqft END AS rent_sqft "
    "FROM fx_rentals",
)
def _(m: Model):
    return conform(m["rentals"], "rentals").select("pid", "rent", "rent_sqft")


step(
    "c_indicators",
    "SELECT CASE WHEN length(block_id) < 15 THEN lpad(block_id, 15, '0') ELSE block_id END AS block_id, "
    + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM fx_access_indicators)) AS {c}" for c in INDICATORS)
    + " FROM fx_access_indicators",
)


@query("q_access_indicators", "SELECT * FROM c_indicators")
def _(m: Model):
    return conform(m["access_indicators"], "access_indicators")


@query(
    "q_parcel_access",
    "SELECT p.parcel_id, " + ", ".join(f"i.{c}" for c in INDICATORS)
    + " FROM fx_parcels p LEFT JOIN c_indicators i USING (block_id)",
)
def _(m: Model):
    indicators = conform(m["access_indicators"], "access_indicators")
    return add_parcel_columns(m["parcels"], indicators).select("parcel_id", *INDICATORS)


# ---------------------------------------------------------------- dummies and recodes

step(
    "c_jobs",
    "SELECT *, " + ", ".join(
        dummy(f"sector_id IN ({', '.join(map(str, codes))})", name)
        for name, codes in {**JOB_SECTORS, **TOD_SECTORS}.items()
    ) + " FROM fx_jobs",
)


@query("q_job_sectors", "SELECT job_id, " + ", ".join((*JOB_SECTORS, *TOD_SECTORS)) + " FROM c_jobs")
def _(m: Model):
    return add_job_columns(m["jobs"]).select("job_id", *JOB_SECTORS, *TOD_SECTORS)


PERSON_TESTS = {
    "no_higher_ed": "edu < 21", "age_under_45": "age < 45", "lessGED": "edu < 16",
    "GED": "edu IN (16, 17)", "somebach": "edu IN (16, 17)", "Assoc": "edu = 20", "Bach": "edu = 21",
    "white": "race_id = 1", "minority": "race_id <> 1 OR race_id IS NULL",
    "age_16less25": "age >= 16 AND age < 25",
}
step(
    "c_persons",
    "SELECT *, " + ", ".join(dummy(test, name) for name, test in PERSON_TESTS.items())
    + ", sex - 1 AS female FROM fx_persons",
)


@query("q_person_dummies", "SELECT person_id, " + ", ".join((*PERSON_TESTS, "female")) + " FROM c_persons")
def _(m: Model):
    return add_person_columns(m["persons"]).select("person_id", *PERSON_TESTS, "female")


_BINS = [
    (name, (f"income >= {low}" if i == 0 else f"income > {low}") + (f" AND income <= {high}" if high else ""))
    for i, (name, low, high) in enumerate(INCOME_BINS)
]
HOUSEHOLD_TESTS = {
    "hh_inc_under_25k": "income > 10 AND income < 25000",
    "hh_inc_25_to_75k": "income >= 25000 AND persons < 75000",
    "hh_inc_75_to_200k": "income >= 75000 AND income < 200000",
    **dict(_BINS),
    **{f"tenure_{i}": f"tenure = {i}" for i in (1, 2, 3, 4)},
    "building_type_2": "building_type = 2", "hh_inc_150kplus": "income >= 150000",
    "hh_size_1per": "persons = 1",
}
step(
    "c_households",
    "SELECT *, " + ", ".join(dummy(test, name) for name, test in HOUSEHOLD_TESTS.items())
    + ", single_family AS single_family_int FROM fx_households",
)


@query("q_household_dummies", "SELECT household_id, " + ", ".join((*HOUSEHOLD_TESTS, "single_family_int")) + " FROM c_households")
def _(m: Model):
    return add_household_columns(m["households"]).select("household_id", *HOUSEHOLD_TESTS, "single_family_int")


step(
    "c_home",
    "SELECT h.household_id, p.zone_id FROM fx_households h JOIN fx_units n ON n.unit_id = h.unit_id "
    "JOIN fx_buildings b ON b.building_id = n.building_id JOIN fx_parcels p ON p.parcel_id = b.parcel_id",
)
step(
    "c_person_zone",
    "SELECT q.*, CAST(z.zone_id AS DOUBLE) AS zone_id_home FROM c_persons q "
    "LEFT JOIN c_home z ON z.household_id = q.household_id",
)
step(
    "c_job_zone",
    "SELECT j.*, CAST(p.zone_id AS DOUBLE) AS zone_id_work FROM c_jobs j "
    "LEFT JOIN fx_buildings b ON b.building_id = j.building_id "
    "LEFT JOIN fx_parcels p ON p.parcel_id = b.parcel_id",
)


def home_persons(m: Model):
    return add_zone_id_home(m["persons"], m["households"], m["units"], m["buildings"], m["parcels"])


def work_jobs(m: Model):
    return add_zone_id_work(m["jobs"], m["buildings"], m["parcels"])


@query(
    "q_zone_home_work",
    "SELECT 'person' AS kind, person_id AS id, zone_id_home AS zone FROM c_person_zone UNION ALL "
    "SELECT 'job', job_id, zone_id_work FROM c_job_zone",
)
def _(m: Model):
    a = home_persons(m).selectExpr("'person' AS kind", "person_id AS id", "zone_id_home AS zone")
    b = work_jobs(m).selectExpr("'job' AS kind", "job_id AS id", "zone_id_work AS zone")
    return a.unionByName(b)


@query(
    "q_filter_workers",
    "SELECT person_id, age, hours, zone_id_home FROM c_person_zone "
    "WHERE worker = 1 AND work_at_home = 0 AND zone_id_home IS NOT NULL",
)
def _(m: Model):
    kept = filter_all(home_persons(m), WORKER_FILTERS)
    return kept.select("person_id", "age", "hours", "zone_id_home")


step(
    "c_recoded",
    "SELECT p.person_id, p.sex AS GEND, p.age AS AGE, CAST(CASE WHEN race_id <= 3 THEN race_id "
    "WHEN race_id <= 5 THEN 3 WHEN race_id = 6 THEN 4 WHEN race_id = 7 THEN 5 WHEN race_id <= 9 THEN 97 "
    "END AS BIGINT) AS RACE1, p.worker AS JOBS, CAST(CASE WHEN edu <= 15 THEN 1 WHEN edu <= 17 THEN 2 "
    "WHEN edu <= 19 THEN 3 WHEN edu = 20 THEN 4 WHEN edu = 21 THEN 5 WHEN edu <= 24 THEN 6 END AS BIGINT) "
    "AS EDUCA, p.household_id, w.job_id, CASE WHEN TOD IN (2, 3) THEN 'EA' WHEN TOD IN (12, 14) THEN 'AM' "
    "WHEN TOD IN (22, 23, 24) THEN 'MD' END AS TOD FROM fx_persons p JOIN fx_persons_work w "
    "ON w.person_id = p.person_id",
)


def working_persons(m: Model):
    return m["persons"].join(m["persons_work"], "person_id")


@query(
    "q_mode_recode",
    "SELECT r.*, " + dummy("tenure = 1", "OWN")
    + " FROM c_recoded r LEFT JOIN fx_households h ON h.household_id = r.household_id",
)
def _(m: Model):
    owners = m["households"].select("household_id", "tenure")
    joined = mode_persons(working_persons(m)).join(owners, "household_id", "left")
    return joined.withColumn("OWN", F.coalesce(F.col("tenure") == 1, F.lit(False)).cast("int")).drop("tenure")


# ---------------------------------------------------------------- joins


@query(
    "q_merge_jobs",
    "SELECT j.job_id, j.building_id, j.sector_id, b.parcel_id, b.residential_units, p.zone_id, p.x, p.y "
    "FROM fx_jobs j JOIN fx_buildings b ON b.building_id = j.building_id "
    "JOIN fx_parcels p ON p.parcel_id = b.parcel_id",
)
def _(m: Model):
    return merge_tables(
        m.tables("jobs", "buildings", "parcels"), "jobs", ["jobs", "buildings", "parcels"],
        ["job_id", "building_id", "sector_id", "parcel_id", "residential_units", "zone_id", "x", "y"],
    )


@query(
    "q_merge_households",
    "SELECT h.household_id, h.building_id, h.unit_id, h.income, b.parcel_id, b.building_type_id, p.zone_id, "
    "p.x, p.y FROM fx_households h JOIN fx_units n ON n.unit_id = h.unit_id "
    "JOIN fx_buildings b ON b.building_id = n.building_id JOIN fx_parcels p ON p.parcel_id = b.parcel_id",
)
def _(m: Model):
    names = ["households", "units", "buildings", "parcels"]
    return merge_tables(
        m.tables(*names), "households", names,
        ["household_id", "building_id", "unit_id", "income", "parcel_id", "building_type_id", "zone_id",
         "x", "y"],
    )


@query(
    "q_update_column",
    "SELECT p.person_id, coalesce(w.TOD, p.hours) AS hours FROM fx_persons p LEFT JOIN (SELECT person_id, TOD "
    "FROM fx_persons_work JOIN fx_jobs USING (job_id)) w ON w.person_id = p.person_id",
)
def _(m: Model):
    values = m["persons_work"].join(m["jobs"].select("job_id"), "job_id").selectExpr(
        "person_id", "TOD AS hours"
    )
    return update_column(m["persons"].select("person_id", "hours"), "person_id", values, "hours")


@query(
    "q_complement",
    "SELECT person_id, household_id FROM fx_persons WHERE person_id NOT IN (SELECT person_id FROM "
    "fx_persons_work WHERE TOD = 24)",
)
def _(m: Model):
    part = m["persons_work"].where("TOD = 24")
    return complement(m["persons"], part, "person_id").select("person_id", "household_id")


step(
    "c_survey",
    "SELECT s.obs_id, s.job_id, CAST(p.zone_id AS DOUBLE) AS zone_id_home, "
    + dummy("s.AGE < 45", "age_under_45") + ", " + dummy("s.EDUCA < 5", "no_higher_ed") + ", s.AGE AS age, "
    + dummy("h.INCOM < 3", "hh_inc_under_25k") + ", " + dummy("h.INCOM BETWEEN 3 AND 5", "hh_inc_25_to_75k")
    + ", " + dummy("h.INCOM BETWEEN 6 AND 8", "hh_inc_75_to_200k") + ", h.INCOM AS income "
    "FROM fx_survey_persons s JOIN fx_survey_households h ON h.SAMPN = s.SAMPN "
    "JOIN fx_jobs j ON j.job_id = s.job_id JOIN fx_buildings b ON b.building_id = s.building_id "
    "JOIN fx_parcels p ON p.parcel_id = b.parcel_id WHERE s.AGE < 115 AND h.INCOM < 98 AND s.EDUCA < 98",
)


@query("q_survey_obs", "SELECT * FROM c_survey")
def _(m: Model):
    return survey_observations(
        m.tables("survey_persons", "survey_households", "jobs", "buildings", "parcels")
    )


# ---------------------------------------------------------------- totals and profiles

step(
    "c_zone_totals",
    "SELECT z.zone_id, CAST(coalesce(j.n, 0) AS BIGINT) AS total_jobs, coalesce(b.n, 0) AS "
    "sum_residential_units, coalesce(h.p, 0) AS sum_persons, coalesce(h.i, 0) AS sum_income FROM fx_zones z "
    "LEFT JOIN (SELECT zone_id_work AS zone_id, count(*) AS n FROM c_job_zone GROUP BY 1) j USING (zone_id) "
    "LEFT JOIN (SELECT zone_id, sum(residential_units) AS n FROM fx_buildings JOIN fx_parcels "
    "USING (parcel_id) GROUP BY 1) b USING (zone_id) "
    "LEFT JOIN (SELECT zone_id, sum(persons) AS p, sum(income) AS i FROM fx_households JOIN fx_buildings "
    "USING (building_id) JOIN fx_parcels USING (parcel_id) GROUP BY 1) h USING (zone_id)",
)
step(
    "c_zone_income",
    "SELECT z.zone_id, coalesce(a.m, 0) AS avg_income FROM fx_zones z LEFT JOIN (SELECT zone_id, avg(m) AS m "
    "FROM (SELECT parcel_id, avg(m) AS m FROM (SELECT building_id, avg(income) AS m FROM fx_households "
    "GROUP BY 1) JOIN fx_buildings USING (building_id) GROUP BY 1) JOIN fx_parcels USING (parcel_id) "
    "GROUP BY 1) a USING (zone_id)",
)


@query("q_zone_totals", "SELECT * FROM c_zone_totals")
def _(m: Model):
    return zone_totals(m.tables("zones", "parcels", "buildings", "households", "jobs"))


@query("q_zone_avg_income", "SELECT zone_id, round(avg_income, 6) AS avg_income FROM c_zone_income", 6)
def _(m: Model):
    return zone_avg_income(m.tables("zones", "parcels", "buildings", "households"))


_PROFILED = ("income", "persons", "children", "cars")


@query(
    "q_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM fx_households"
        for c in _PROFILED
    ),
    4,
)
def _(m: Model):
    return profile(m["households"], list(_PROFILED))
