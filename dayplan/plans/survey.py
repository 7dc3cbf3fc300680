"""Observation table and estimation of the workplace model from a travel survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.functions.nulls import flag
from dayplan.operators.choice import Terms, choice_table
from dayplan.operators.fit import FitResult, fit_conditional_logit
from dayplan.operators.relations import building_zones, filter_all
from dayplan.plans.workplace import home_work_interactions, workplace_alternatives
from dayplan.specs.choice import ALTERNATIVES_SAMPLED, SURVEY_FILTERS, WLCM_GEN_TT

OBSERVATION_COLUMNS = [
    "obs_id", "job_id", "zone_id_home", "age_under_45", "no_higher_ed", "age",
    "hh_inc_under_25k", "hh_inc_25_to_75k", "hh_inc_75_to_200k", "income",
]


def survey_observations(tables: dict[str, DataFrame]) -> DataFrame:
    """Surveyed workers whose job is known, with home zone and recoded attributes."""
    zones = building_zones(tables["buildings"], tables["parcels"])
    merged = (
        tables["survey_persons"]
        .where(F.col("job_id").isNotNull())
        .join(tables["jobs"].select("job_id"), "job_id", "left_semi")
        .join(tables["survey_households"].select("SAMPN", "INCOM"), "SAMPN")
        .join(zones, "building_id")
        .withColumnsRenamed(
            {"zone_id": "zone_id_home", "AGE": "age", "EDUCA": "edu", "INCOM": "income"}
        )
    )
    age, edu, income = F.col("age"), F.col("edu"), F.col("income")
    coded = merged.withColumns(
        {
            "no_higher_ed": flag(edu < 5),
            "age_under_45": flag(age < 45),
            "hh_inc_under_25k": flag(income < 3),
            "hh_inc_25_to_75k": flag((income > 2) & (income < 6)),
            "hh_inc_75_to_200k": flag((income > 5) & (income < 9)),
            "zone_id_home": F.col("zone_id_home").cast("double"),
        }
    )
    return filter_all(coded, SURVEY_FILTERS).select(*OBSERVATION_COLUMNS)


def survey_choice_table(
    tables: dict[str, DataFrame],
    access: tuple[str, ...],
    interaction_columns: tuple[str, ...],
    k: int = ALTERNATIVES_SAMPLED,
    salt: str = "survey",
) -> DataFrame:
    """Each observation with its own job and k - 1 sampled others."""
    inter = home_work_interactions(tables["beam_skims_imputed"]).select(
        "zone_id_home", "zone_id_work", *interaction_columns
    )
    return choice_table(
        survey_observations(tables), workplace_alternatives(tables, access), "obs_id", "job_id", k,
        salt, inter, ["zone_id_home", "zone_id_work"], chosen="job_id",
    )


def estimate_workplace_model(
    tables: dict[str, DataFrame],
    terms: Terms = WLCM_GEN_TT,
    access: tuple[str, ...] = ("total_jobs_gen_tt_WALK_TRANSIT_15",),
    interaction_columns: tuple[str, ...] = (
        "dist", "gen_tt_CAR", "gen_cost_CAR", "gen_tt_WALK_TRANSIT"
    ),
    k: int = ALTERNATIVES_SAMPLED,
    salt: str = "survey",
) -> FitResult:
    """Fit the given terms on the survey; the coefficients of ``terms`` are ignored."""
    table = survey_choice_table(tables, access, interaction_columns, k, salt)
    return fit_conditional_logit(table, "obs_id", "chosen", [factors for _, factors in terms])
