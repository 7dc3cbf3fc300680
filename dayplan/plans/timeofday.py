"""Choice of the departure-period pair of each commuter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.functions.draws import uniform
from dayplan.operators.choice import mnl_wide
from dayplan.operators.columns import add_household_columns, job_columns, person_columns
from dayplan.operators.relations import add_zone_id_home, add_zone_id_work, merge_tables, pair_lookup
from dayplan.operators.skims import round_trip_times
from dayplan.specs.choice import TOD_CHOICE
from dayplan.specs.recodes import PERIODS


def tod_features(tables: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Persons with a household and a job, all dummies, and 25 round-trip drive times.

    With ``columns``, only these. However many persons share a pair of zones, no task holds them
    all; see ``pair_lookup``. Dummies of persons and jobs are derived after the joins, so these move narrow rows.
    """
    persons = add_zone_id_home(
        tables["persons"], tables["households"], tables["units"], tables["buildings"],
        tables["parcels"],
    )
    own = person_columns()
    jobs = add_zone_id_work(tables["jobs"], tables["buildings"], tables["parcels"])
    merged = merge_tables(
        {
            "persons": persons,
            "households": add_household_columns(tables["households"]).drop(*own),
            "jobs": jobs.drop(*own, *job_columns()).withColumn("_sector", F.col("sector_id")),
        },
        "persons",
        ["persons", "households", "jobs"],
    )
    # a name that persons or households have is not the job's
    merged = merged.withColumns({n: c for n, c in job_columns("_sector").items() if n not in {*merged.columns, *own}}).drop("_sector")
    named = dict.fromkeys([*persons.columns, *own, *merged.columns])
    merged = merged.withColumns(own).select(*named)
    pair = {"zone_id_home": "orig", "zone_id_work": "dest"}

    def times(wanted: Callable[[DataFrame], DataFrame]) -> DataFrame:
        trips = round_trip_times(tables["mtc_skims"], PERIODS, wanted)
        return trips if columns is None else trips.select("orig", "dest", *[c for c in trips.columns if c in columns])

    if columns is None:
        return pair_lookup(merged, times, pair)
    stored = merged.select(*[c for c in merged.columns if c in columns or c in pair])
    return pair_lookup(stored, times, pair).select(*columns)


def tod_choice_simulate(tables: dict[str, DataFrame], salt: str = "tod") -> DataFrame:
    """(person_id, TOD) drawn from the eight-alternative model."""
    features = tod_features(tables, ["person_id", *TOD_CHOICE.attributes()])
    return mnl_wide(features, TOD_CHOICE, uniform(salt, "person_id"), "TOD").select("person_id", "TOD")
