"""Workplace location choice under job capacity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.operators.choice import Terms, capacity_choice
from dayplan.operators.columns import add_household_columns, add_job_columns, add_person_columns
from dayplan.operators.relations import (
    add_zone_id_home,
    add_zone_id_work,
    filter_all,
    merge_tables,
    update_column,
)
from dayplan.operators.skims import standard_skim_variables
from dayplan.specs.choice import ALTERNATIVES_SAMPLED, WLCM, WLCM_GEN_TT_SIMPLE, WORKER_FILTERS
from dayplan.specs.recodes import JOB_SECTORS

CHOOSER_COLUMNS = [
    "person_id", "zone_id_home", "no_higher_ed", "age_under_45",
    "hh_inc_under_25k", "hh_inc_25_to_75k", "hh_inc_75_to_200k",
]


# measure of the model: skim table, its origin and destination, the column there
NETWORK_MEASURES = {
    "dist_da": ("mtc_skims", "orig", "dest", "da_distance_AM"),
    "tt_da": ("mtc_skims", "orig", "dest", "da_Time_AM"),
    "tt_wTrnW": ("mtc_skims", "orig", "dest", "wTrnW_Time_AM"),
    "cost_da_toll": ("mtc_skims", "orig", "dest", "da_cost_AM"),
}


def workplace_choosers(tables: dict[str, DataFrame]) -> DataFrame:
    """Workers who leave home for work and whose home zone is known."""
    persons = add_zone_id_home(
        tables["persons"], tables["households"], tables["units"], tables["buildings"],
        tables["parcels"],
    )
    merged = merge_tables(
        {
            "persons": add_person_columns(persons),
            "households": add_household_columns(tables["households"]),
        },
        "persons",
        ["persons", "households"],
    )
    return filter_all(merged, WORKER_FILTERS).select(*CHOOSER_COLUMNS)


def workplace_alternatives(
    tables: dict[str, DataFrame], access: tuple[str, ...] | None = None
) -> DataFrame:
    """Jobs with their zone, sector dummies and the zone's accessibility columns."""
    names = access if access is not None else tuple(s.name for s in standard_skim_variables())
    jobs = add_zone_id_work(tables["jobs"], tables["buildings"], tables["parcels"])
    merged = merge_tables(
        {**tables, "jobs": add_job_columns(jobs)}, "jobs", ["jobs", "buildings", "parcels", "zones"]
    )
    return merged.select("job_id", "zone_id_work", *JOB_SECTORS, *names)


def home_work_interactions(skims: DataFrame) -> DataFrame:
    """Imputed skims keyed by home and work zone."""
    return skims.withColumnsRenamed(
        {"from_zone_id": "zone_id_home", "to_zone_id": "zone_id_work"}
    ).withColumns(
        {c: F.col(c).cast("double") for c in ("zone_id_home", "zone_id_work")}
    )


def wlcm_simulate(
    tables: dict[str, DataFrame],
    terms: Terms = WLCM_GEN_TT_SIMPLE,
    access: tuple[str, ...] = ("total_jobs_gen_tt_CAR_15",),
    interaction_columns: tuple[str, ...] = ("dist", "gen_tt_CAR", "gen_cost_CAR"),
    k: int = ALTERNATIVES_SAMPLED,
    salt: str = "wlcm",
    rounds: int | None = None,
) -> DataFrame:
    """(person_id, job_id, round): one job per placed worker, one worker per job."""
    inter = home_work_interactions(tables["beam_skims_imputed"]).select(
        "zone_id_home", "zone_id_work", *interaction_columns
    )
    return capacity_choice(
        workplace_choosers(tables), workplace_alternatives(tables, access), "person_id", "job_id",
        terms, inter, ["zone_id_home", "zone_id_work"], k, salt, rounds,
    )


def skim_interactions(tables: dict[str, DataFrame], measures: dict[str, tuple[str, str, str, str]]) -> DataFrame:
    """(zone_id_home, zone_id_work, measures): measures of several skim tables side by side.

    Each table gives its columns under the model's names; the pairs meet in one aggregate, so a
    pair that only some tables have keeps what they know. Where a table repeats a pair, the largest
    value counts.
    """
    parts = []
    for source in dict.fromkeys(m[:3] for m in measures.values()):
        table, home, work = source
        own = {name: m[3] for name, m in measures.items() if m[:3] == source}
        parts.append(tables[table].select(
            F.col(home).cast("double").alias("zone_id_home"), F.col(work).cast("double").alias("zone_id_work"),
            *[F.col(own[n]).cast("double").alias(n) if n in own else F.lit(None).cast("double").alias(n) for n in measures]))
    return reduce(DataFrame.unionByName, parts).groupBy("zone_id_home", "zone_id_work").agg(*[F.max(n).alias(n) for n in measures])


def network_alternatives(tables: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Jobs with their zone, sector dummies and ``columns`` of the walk and drive node of their parcel."""
    jobs = add_zone_id_work(tables["jobs"], tables["buildings"], tables["parcels"])
    merged = merge_tables(
        {**tables, "jobs": add_job_columns(jobs)}, "jobs", ["jobs", "buildings", "parcels", "nodeswalk", "nodessmall"])
    return merged.select("job_id", "zone_id_work", *JOB_SECTORS, *columns)


def wlcm_network_simulate(
    tables: dict[str, DataFrame],
    terms: Terms = WLCM,
    node_columns: tuple[str, ...] = ("jobs_1500_walk_retail",),
    measures: dict[str, tuple[str, str, str, str]] = NETWORK_MEASURES,
    k: int = ALTERNATIVES_SAMPLED,
    salt: str = "wlcm",
    rounds: int | None = None,
) -> DataFrame:
    """(person_id, job_id, round) by the model that looks at street networks and period skims.

    ``tables`` hold the node variables as ``nodeswalk`` and ``nodessmall``, and the skim tables that
    ``measures`` names.
    """
    return capacity_choice(
        workplace_choosers(tables), network_alternatives(tables, list(node_columns)), "person_id", "job_id",
        terms, skim_interactions(tables, measures), ["zone_id_home", "zone_id_work"], k, salt, rounds,
    )


def assign_jobs(persons: DataFrame, assignment: DataFrame) -> DataFrame:
    """Persons with ``job_id`` written from a workplace assignment."""
    return update_column(persons, "person_id", assignment.select("person_id", "job_id"), "job_id")
