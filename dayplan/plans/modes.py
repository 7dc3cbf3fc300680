"""Primary commute mode of each person with a job.

Modes: 0 drive alone, 1 shared ride, 2 walk-transit-walk, 3 drive-transit-walk,
4 walk-transit-drive, 5 bike, 6 walk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayplan.functions.draws import uniform
from dayplan.functions.nulls import flag, recode
from dayplan.operators.choice import mnl_wide
from dayplan.operators.relations import building_zones, lookup, pair_lookup
from dayplan.operators.skims import period_columns
from dayplan.specs.choice import MODE_CHOICE
from dayplan.specs.recodes import EDUCATION, MODE_PERIODS, RACE, TOD_PERIOD


def mode_persons(persons: DataFrame, tod13_as_am: bool = False) -> DataFrame:
    """Person attributes in survey codes; ``tod13_as_am`` gives code 13 the morning skims."""
    periods = {**TOD_PERIOD, 13: "AM"} if tod13_as_am else TOD_PERIOD
    return persons.select(
        "person_id",
        F.col("sex").alias("GEND"),
        F.col("age").alias("AGE"),
        recode(F.col("race_id"), RACE).alias("RACE1"),
        F.col("worker").alias("JOBS"),
        recode(F.col("edu"), EDUCATION).alias("EDUCA"),
        "household_id",
        "job_id",
        recode(F.col("TOD"), periods).alias("TOD"),
    )


def _period_pick(by_period: dict[str, dict[str, str]], measure: str) -> Column:
    out = None
    for period, names in by_period.items():
        value = F.col(names[measure]).cast("double") if measure in names else F.lit(None)
        test = F.col("TOD") == period
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.cast("double").alias(measure)


def mode_base(
    tables: dict[str, DataFrame], cars_column: str = "cars", tod13_as_am: bool = False
) -> DataFrame:
    """One row per person with a job: survey-coded attributes, zones, access and skims.

    The skims stay one row per zone pair; the person's period picks the columns, so the
    pair table is not tripled before the join.
    """
    persons = mode_persons(tables["persons"], tod13_as_am)
    zones = building_zones(tables["buildings"], tables["parcels"])
    households = lookup(
        tables["households"].select(
            "household_id", F.col(cars_column).alias("HHVEH"), "tenure",
            F.col("income").alias("INCOM"), F.col("persons").alias("HHSIZ"), "building_id",
        ),
        "building_id", zones, "building_id", {"zone_id": "orig"},
    ).drop("building_id")
    jobs = lookup(
        tables["jobs"].select("job_id", "building_id"),
        "building_id", zones, "building_id", {"zone_id": "dest"},
    ).drop("building_id")
    access = tables["zone_accessibility"]
    access_columns = [c for c in access.columns if c != "taz1454"]
    base = (
        persons.join(households, "household_id", "left")
        .join(jobs, "job_id")
        .join(access, F.col("orig") == F.col("taz1454"), "left")
        .fillna(0, subset=["taz1454", *access_columns])
    )
    mtc = tables["mtc_skims"]
    by_period = {
        p: {bare: c for c, bare in period_columns(mtc.columns, p).items()} for p in MODE_PERIODS
    }
    measures = sorted({m for names in by_period.values() for m in names})
    sources = [c for names in by_period.values() for c in names.values()]
    joined = pair_lookup(base, mtc.select("orig", "dest", *sources), {"orig": "orig", "dest": "dest"})
    return joined.select(
        *base.columns,
        *[_period_pick(by_period, m) for m in measures],
        flag(F.col("tenure") == 1).alias("OWN"),
    )


def primary_mode_choice_simulate(
    tables: dict[str, DataFrame],
    cars_column: str = "cars",
    tod13_as_am: bool = False,
    salt: str = "mode",
) -> DataFrame:
    """The mode base with ``primary_commute_mode``; unknown skims leave it null."""
    base = mode_base(tables, cars_column, tod13_as_am)
    return mnl_wide(base, MODE_CHOICE, uniform(salt, "person_id"), "primary_commute_mode")
