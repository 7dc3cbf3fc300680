"""The whole run: from raw tables to the plans of every placed worker."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import Model
from checks.oracle import step, u, variant
from checks.q_choice import ROUNDS, wide_choice
from checks.registry import query
from dayplan.plans.pipeline import run
from dayplan.session import Scratch
from dayplan.sources.readers import conform
from dayplan.specs.choice import TOD_CHOICE

SEED = "1"
INPUTS = ("parcels", "buildings", "units", "households", "persons", "jobs", "establishments", "zones", "mtc_skims",
          "beam_skims_raw", "zone_accessibility", "rentals", "access_indicators")

# the steps of the single queries once more, each on what the step before it gave and with the run's seed
_won = [variant(f"c_won{r}", "run", {"md5('wlcm|": f"md5('{SEED}|wlcm|"}) for r in range(1, ROUNDS + 1)]
step("c_run_jobs", " UNION ALL ".join(f"SELECT person_id, job_id FROM {w}" for w in _won))
_weights = variant("c_tod_weights", "run", {"fx_persons_work": "c_run_jobs"})
step(
    "c_run_work",
    f"SELECT j.person_id, j.job_id, t.TOD FROM c_run_jobs j LEFT JOIN (SELECT person_id, "
    f"{wide_choice(TOD_CHOICE, u(f'{SEED}|tod', 'person_id'))} AS TOD FROM {_weights}) t ON t.person_id = j.person_id",
)
_day = {"fx_persons_work": "c_run_work", "md5('depart|": f"md5('{SEED}|depart|", "md5('mode|": f"md5('{SEED}|mode|"}
_plans, _modes = variant("c_plans", "day", _day), variant("c_modes", "day", _day)


def run_inputs(m: Model) -> dict:
    tables = {name: conform(m[name], name) for name in INPUTS}
    for kind in ("drive", "walk"):
        tables[f"{kind}_nodes"], tables[f"{kind}_edges"] = m["nodes"], m["edges"]
    return tables


@query(
    "q_run_plans",
    "SELECT personId, w.job_id, w.TOD, m.primary_commute_mode, planElement, planElementIndex, activityType, x, y, "
    f"round(endTime, 6) AS endTime FROM {_plans} p JOIN c_run_work w ON w.person_id = p.personId "
    f"LEFT JOIN {_modes} m ON m.person_id = p.personId",
)
def _(m: Model):
    out = run(m.spark, run_inputs(m), seed=SEED, resume_path=Scratch(m.spark, "run").root)
    work = out["persons"].select(F.col("person_id").alias("personId"), "job_id", F.col("TOD").cast("bigint").alias("TOD"))
    modes = out["persons_CHTS_format"].select(F.col("person_id").alias("personId"), "primary_commute_mode")
    return out["plans"].join(work, "personId").join(modes, "personId", "left").select(
        "personId", "job_id", "TOD", "primary_commute_mode", "planElement", "planElementIndex", "activityType", "x", "y",
        F.round("endTime", 6).alias("endTime"))
