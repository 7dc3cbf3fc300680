"""Travel skims: imputation, accessibility, period views."""

from __future__ import annotations

from dayplan.operators.skims import (
    SkimVariable,
    fix_distances,
    impute_skims,
    mode_rates,
    morning_average,
    morning_cells,
    pivot_modes,
    skim_access,
    skims_by_period,
    standard_skim_variables,
)
from dayplan.operators.zones import zone_totals, zone_variables
from dayplan.plans.timeofday import tod_features
from dayplan.operators.relations import pair_lookup
from dayplan.session import materialize
from dayplan.sources.readers import conform
from checks.fixtures import SKIM_MEASURES, Model
from checks.oracle import step
from checks.q_tables import round_all, working_persons
from checks.registry import query
from dayplan.specs.choice import TOD_CHOICE
from dayplan.specs.recodes import MODE_PERIODS, PERIODS

MODES = ("BIKE", "CAR", "WALK_TRANSIT")
IMPUTED = ["dist"] + [f"{m}_{mode}" for m in ("gen_cost", "gen_tt") for mode in MODES]


def observations(m: Model):
    return conform(m["beam_skims_raw"], "beam_skims_raw")


step(
    "c_obs",
    "SELECT r.origTaz AS from_zone_id, r.destTaz AS to_zone_id, r.mode, r.hour, r.numObservations, "
    "r.generalizedTimeInS / 60 AS gen_tt, r.generalizedTimeInS, r.generalizedCost AS gen_cost, "
    "CASE WHEN r.distanceInM = 0 OR r.origTaz = r.destTaz THEN s.da_distance_AM * CAST(1609.34 AS DOUBLE) "
    "ELSE r.distanceInM END AS distanceInM FROM fx_beam_skims_raw r "
    "LEFT JOIN fx_mtc_skims s ON s.orig = r.origTaz AND s.dest = r.destTaz",
)
step(
    "c_morning",
    "SELECT from_zone_id, to_zone_id, mode, sum(gen_tt * numObservations) / sum(numObservations) AS gen_tt, "
    "sum(gen_cost * numObservations) / sum(numObservations) AS gen_cost FROM c_obs "
    "WHERE hour IN (7, 8, 9) AND numObservations > 0 GROUP BY ALL",
)
step(
    "c_rates",
    "SELECT mode, sum(gen_tt / distanceInM * numObservations) / sum(numObservations) AS gen_time_per_m, "
    "sum(gen_cost / distanceInM * numObservations) / sum(numObservations) AS gen_cost_per_m FROM c_obs "
    "WHERE hour IN (7, 8, 9) AND numObservations > 0 AND distanceInM > 0 GROUP BY mode",
)
step(
    "c_wide",
    "SELECT from_zone_id, to_zone_id, "
    + ", ".join(
        f"max({m}) FILTER (WHERE mode = '{mode}') AS {m}_{mode}" for m in ("gen_cost", "gen_tt") for mode in MODES
    )
    + " FROM c_morning GROUP BY ALL",
)
step(
    "c_imputed",
    "SELECT s.orig AS from_zone_id, s.dest AS to_zone_id, s.da_distance_AM * CAST(1609.34 AS DOUBLE) AS dist, "
    + ", ".join(
        f"coalesce(w.{m}_{mode}, s.da_distance_AM * CAST(1609.34 AS DOUBLE) * (SELECT {rate} FROM c_rates "
        f"WHERE mode = '{mode}')) AS {m}_{mode}"
        for m, rate in (("gen_cost", "gen_cost_per_m"), ("gen_tt", "gen_time_per_m"))
        for mode in MODES
    )
    + " FROM fx_mtc_skims s LEFT JOIN c_wide w ON w.from_zone_id = s.orig AND w.to_zone_id = s.dest",
)


@query(
    "q_skim_distance_fix",
    "SELECT from_zone_id, to_zone_id, mode, hour, numObservations, generalizedTimeInS, gen_cost, distanceInM "
    "FROM c_obs",
)
def _(m: Model):
    return fix_distances(observations(m), m["mtc_skims"])


@query(
    "q_skim_am_average",
    "SELECT from_zone_id, to_zone_id, mode, " + round_all(("gen_tt", "gen_cost"), 9) + " FROM c_morning", 9,
)
def _(m: Model):
    return morning_average(observations(m))


@query("q_mode_rates", "SELECT mode, " + round_all(("gen_time_per_m", "gen_cost_per_m"), 9) + " FROM c_rates", 9)
def _(m: Model):
    return mode_rates(morning_cells(observations(m)), m["mtc_skims"])


@query("q_skims_wide", "SELECT from_zone_id, to_zone_id, " + round_all(IMPUTED[1:], 9) + " FROM c_wide", 9)
def _(m: Model):
    return pivot_modes(morning_average(observations(m)), list(MODES))


@query(
    "q_impute_skims", "SELECT from_zone_id, to_zone_id, " + round_all(IMPUTED, 9) + " FROM c_imputed", 9
)
def _(m: Model):
    return impute_skims(m["mtc_skims"], observations(m))


step("c_zones", "SELECT * FROM c_zone_totals JOIN c_zone_income USING (zone_id)")


def access_sql(specs, zones: str, digits: int | None) -> str:
    def cell(s):
        agg = "sum" if s.agg == "sum" else "avg"
        value = f"coalesce({agg}(CAST(d.{s.value} AS DOUBLE)) FILTER (WHERE k.{s.impedance} < {s.cutoff}), 0) + any_value(z.{s.value})"
        value = f"ln(1 + {value})" if s.log else value
        return f"{value if digits is None else f'round({value}, {digits})'} AS {s.name}"

    return (
        "SELECT z.zone_id, " + ", ".join(cell(s) for s in specs)
        + f" FROM {zones} z LEFT JOIN c_imputed k ON k.from_zone_id = z.zone_id "
        f"LEFT JOIN {zones} d ON d.zone_id = k.to_zone_id GROUP BY z.zone_id"
    )


_ONE = [
    SkimVariable("jobs_near", "total_jobs", "gen_tt_CAR", 20),
    SkimVariable("jobs_near_log", "total_jobs", "gen_tt_CAR", 20, log=True),
]


@query("q_skim_access_one", access_sql(_ONE, "c_zone_totals", 6), 6)
def _(m: Model):
    zones = zone_totals(m.tables("zones", "parcels", "buildings", "households", "jobs"))
    skims = impute_skims(m["mtc_skims"], observations(m))
    return skim_access(zones, skims, _ONE).select("zone_id", *[s.name for s in _ONE])


def zones_with_access(m: Model):
    m.keep("jobs")
    zones = materialize(
        zone_variables(m.tables("zones", "parcels", "buildings", "households", "jobs")), "zones"
    )
    return skim_access(zones, imputed(m), standard_skim_variables())


def imputed(m: Model):
    """Imputed skims, made once per model: a projection of what the imputation stores."""
    if "beam_skims_imputed" not in m._tables:
        m._tables["beam_skims_imputed"] = impute_skims(m["mtc_skims"], observations(m))
    return m._tables["beam_skims_imputed"]


step("c_zone_access", "SELECT * FROM c_zones JOIN (" + access_sql(standard_skim_variables(), "c_zones", None) + ") USING (zone_id)")


@query(
    "q_skim_access_all",
    "SELECT zone_id, " + round_all([s.name for s in standard_skim_variables()], 4) + " FROM c_zone_access", 4,
)
def _(m: Model):
    return zones_with_access(m).select("zone_id", *[s.name for s in standard_skim_variables()])


_LONG = [
    (mode, measure, measure if measure == "Time" else measure.capitalize())
    for mode, measures in SKIM_MEASURES.items() for measure in measures
]
step(
    "c_by_period",
    " UNION ALL ".join(
        f"SELECT orig, dest, '{p}' AS TOD, "
        + ", ".join(f"{mode}_{a}_{p} AS {mode}_{b}" for mode, a, b in _LONG) + " FROM fx_mtc_skims"
        for p in MODE_PERIODS
    ),
)


@query("q_skims_by_period", "SELECT * FROM c_by_period")
def _(m: Model):
    return skims_by_period(m["mtc_skims"])


_TIMES = [(a, b) for a in PERIODS for b in PERIODS]
step(
    "c_tod_features",
    "SELECT q.*, h.* EXCLUDE (household_id, building_id, persons), h.persons, j.* EXCLUDE (job_id, building_id), "
    + ", ".join(f"o.da_Time_{a} + r.da_Time_{b} AS da_Time_{a}_{b}" for a, b in _TIMES)
    + " FROM (SELECT p.*, w.job_id FROM c_person_zone p JOIN fx_persons_work w USING (person_id)) q "
    "JOIN c_households h ON h.household_id = q.household_id JOIN c_job_zone j ON j.job_id = q.job_id "
    "LEFT JOIN fx_mtc_skims o ON o.orig = q.zone_id_home AND o.dest = j.zone_id_work "
    "LEFT JOIN fx_mtc_skims r ON r.orig = j.zone_id_work AND r.dest = q.zone_id_home",
)
_FEATURES = [a for a in TOD_CHOICE.coefficients if a != "intercept" and not a.startswith("da_Time")]
_FEATURES += [f"da_Time_{a}_{b}" for a, b in _TIMES] + ["zone_id_home", "zone_id_work"]


def commuters(m: Model) -> dict:
    """Model tables whose persons hold a job and a time-of-day code."""
    names = ("households", "units", "buildings", "parcels", "jobs", "mtc_skims")
    return {**m.tables(*names), "persons": working_persons(m)}


@query("q_tod_features", "SELECT person_id, " + ", ".join(_FEATURES) + " FROM c_tod_features")
def _(m: Model):
    return tod_features(commuters(m)).select("person_id", *_FEATURES)


# a third of all rows on one pair of zones, some on pairs that the table does not have, some without a zone
_HOT = ("SELECT l_orderkey * 8 + l_linenumber AS id, CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_linenumber = 7 THEN NULL "
        "ELSE l_suppkey END AS home, CASE WHEN l_orderkey % 3 = 0 THEN 2 ELSE 1 + l_partkey % 50 END AS work FROM {lineitem}")


@query(
    "q_hot_pair",
    "SELECT id, home, work, da_Time_AM, walk_distance_AM FROM (" + _HOT.format(lineitem="lineitem") + ") r "
    "LEFT JOIN fx_mtc_skims s ON s.orig = r.home AND s.dest = r.work",
)
def _(m: Model):
    rows = m.spark.sql(_HOT, lineitem=m["lineitem"])
    skims = m["mtc_skims"].select("orig", "dest", "da_Time_AM", "walk_distance_AM")
    return pair_lookup(rows, skims, {"home": "orig", "work": "dest"})
