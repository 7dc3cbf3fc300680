"""The whole run: accessibility, workplace, departure, autos, mode, plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dayplan.operators.columns import add_node_columns, add_parcel_columns
from dayplan.operators.qa import coverage
from dayplan.operators.relations import add_zone_id_home, update_column
from dayplan.operators.skims import impute_skims
from dayplan.plans.access import attach_node_ids, node_variables, zone_access
from dayplan.plans.activities import activity_plans, trip_table
from dayplan.plans.autos import auto_ownership_simulate
from dayplan.plans.departures import departure_times
from dayplan.plans.modes import primary_mode_choice_simulate
from dayplan.plans.steps import Steps, fingerprint
from dayplan.plans.timeofday import tod_choice_simulate
from dayplan.plans.workplace import assign_jobs, wlcm_simulate
from dayplan.session import side_by_side
from dayplan.sources.writers import accessibility


def with_skims(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables with imputed skims, built from the raw ones where they are not given."""
    if "beam_skims_imputed" in tables:
        return dict(tables)
    if "beam_skims_raw" not in tables:
        raise FileNotFoundError("neither imputed nor raw skims are given")
    return {
        **tables, "beam_skims_imputed": impute_skims(tables["mtc_skims"], tables["beam_skims_raw"])
    }


def run(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    seed: str = "1",
    mode: str = "compute",
    access_path: str | None = None,
    cars_column: str = "cars",
    tod13_as_am: bool = False,
    resume_path: str | None = None,
) -> dict[str, DataFrame]:
    """All output tables. Results depend on ``seed`` only, not on partitioning.

    Tables are stored where a later step would otherwise recompute an iterative or
    expensive one: skims, node ids, accessibility, workplaces, and the persons updates.
    With ``resume_path`` they are stored there, and a later run with the same inputs and
    settings goes on behind the last step that was finished; see ``Steps``.
    """
    access = accessibility(spark, access_path or "", mode) if mode == "stored" else {}
    key = ""
    if resume_path:
        settings = {"seed": seed, "mode": mode, "cars_column": cars_column, "tod13_as_am": tod13_as_am}
        key = fingerprint({**tables, **{f"access {n}": t for n, t in access.items()}}, settings)
    steps = Steps(spark, resume_path, key)
    out = dict(tables)
    out["beam_skims_imputed"] = steps.table("skims", lambda: with_skims(tables)["beam_skims_imputed"])
    out = attach_node_ids(out, steps.table)

    def build() -> dict[str, DataFrame]:
        parts = side_by_side(
            lambda: steps.table("nodes-walk", lambda: node_variables(out, "walk")),
            lambda: steps.table("nodes-drive", lambda: node_variables(out, "drive")),
            lambda: steps.table("zones", lambda: zone_access(out)))
        return dict(zip(("nodeswalk", "nodessmall", "zones"), parts))

    out.update(access or accessibility(spark, access_path or f"{steps.path}/access{key}", mode, build))

    def with_jobs() -> DataFrame:
        return assign_jobs(out["persons"], wlcm_simulate(out, salt=f"{seed}|wlcm"))

    def with_codes() -> DataFrame:
        return update_column(out["persons"], "person_id", tod_choice_simulate(out, salt=f"{seed}|tod"), "TOD")

    def with_times() -> DataFrame:
        times = steps.table("times", lambda: departure_times(out["persons"], salt=f"{seed}|depart"))
        persons = out["persons"]
        for column in ("HW_ST", "WH_ST"):
            persons = update_column(persons, "person_id", times, column)
        return persons

    def with_cars() -> DataFrame:
        derived = {
            **out,
            "nodeswalk": add_node_columns(out["nodeswalk"], "walk"),
            "nodessmall": add_node_columns(out["nodessmall"], "drive"),
            "parcels": add_parcel_columns(out["parcels"], out["access_indicators"]),
        }
        cars = auto_ownership_simulate(derived, salt=f"{seed}|cars", derive=False)
        return update_column(out["households"], "household_id", cars, "cars_alt")

    # who has which car does not depend on who works where
    out["persons"], households = side_by_side(
        lambda: steps.table("persons-jobs", with_jobs), lambda: steps.table("households-cars", with_cars))
    out["persons"] = steps.table("persons-tod", with_codes)
    out["persons"] = steps.table("persons-times", with_times)
    out["households"] = households
    out["persons_CHTS_format"] = steps.table(
        "modes", lambda: primary_mode_choice_simulate(out, cars_column, tod13_as_am, salt=f"{seed}|mode"))
    out["plans"] = activity_plans(trip_table(out))
    return out


def run_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """Coverage of a finished run."""
    persons = add_zone_id_home(
        tables["persons"], tables["households"], tables["units"], tables["buildings"],
        tables["parcels"],
    )
    return coverage(
        persons, tables["households"], tables["persons_CHTS_format"], tables["plans"]
    )
