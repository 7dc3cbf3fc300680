"""Derived columns of the entity tables, each a plain Column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayplan.functions.nulls import finite, flag, ratio
from dayplan.operators.order_stats import exact_medians
from dayplan.operators.relations import lookup
from dayplan.specs.network import PRESENCE, drive_ratios, walk_ratios
from dayplan.specs.recodes import INCOME_BINS, JOB_SECTORS, PARCEL_ACCESS, TOD_SECTORS


def dummy_isin(column: str, values: list) -> Column:
    return flag(F.col(column).isin(values))


def job_columns(sector: str = "sector_id") -> dict[str, Column]:
    return {n: dummy_isin(sector, v) for n, v in {**JOB_SECTORS, **TOD_SECTORS}.items()}


def person_columns() -> dict[str, Column]:
    edu, age = F.col("edu"), F.col("age")
    white = dummy_isin("race_id", [1])
    return {
        "no_higher_ed": flag(edu < 21),
        "age_under_45": flag(age < 45),
        "lessGED": flag(edu < 16),
        "GED": dummy_isin("edu", [16, 17]),
        "somebach": dummy_isin("edu", [16, 17]),
        "Assoc": dummy_isin("edu", [20]),
        "Bach": dummy_isin("edu", [21]),
        "female": F.col("sex") - 1,
        "white": white,
        "minority": flag(white == 0),
        "age_16less25": flag((age >= 16) & (age < 25)),
    }


def household_columns(strict_income: bool = False) -> dict[str, Column]:
    """``strict_income`` bounds the middle band by income; by default it is bounded by
    the household size, which every household passes."""
    income, persons = F.col("income"), F.col("persons")
    bounded = income if strict_income else persons
    out = {
        "hh_inc_under_25k": flag((income > 10) & (income < 25000)),
        "hh_inc_25_to_75k": flag((income >= 25000) & (bounded < 75000)),
        "hh_inc_75_to_200k": flag((income >= 75000) & (income < 200000)),
    }
    for i, (name, low, high) in enumerate(INCOME_BINS):
        test = income >= low if i == 0 else income > low
        out[name] = flag(test if high is None else test & (income <= high))
    for code in (1, 2, 3, 4):
        out[f"tenure_{code}"] = flag(F.col("tenure") == code)
    out["single_family_int"] = F.col("single_family").cast("int")
    out["building_type_2"] = flag(F.col("building_type") == 2)
    out["hh_inc_150kplus"] = flag(income >= 150000)
    out["hh_size_1per"] = flag(persons == 1)
    return out


def add_job_columns(jobs: DataFrame) -> DataFrame:
    return jobs.withColumns(job_columns())


def add_person_columns(persons: DataFrame) -> DataFrame:
    return persons.withColumns(person_columns())


def add_household_columns(households: DataFrame, strict_income: bool = False) -> DataFrame:
    return households.withColumns(household_columns(strict_income))


def add_parcel_columns(parcels: DataFrame, indicators: DataFrame) -> DataFrame:
    """The 13 block-level access indicators by one join."""
    return lookup(parcels, "block_id", indicators, "block_id", list(PARCEL_ACCESS))


def fill_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace infinite and missing values by the column median, taken with the
    infinities in place. All medians come from the same few passes."""
    medians = {c: m for c, m in exact_medians(df, columns).items() if m is not None}
    return df.withColumns({c: F.coalesce(finite(F.col(c)), F.lit(m)) for c, m in medians.items()})


def add_node_columns(nodes: DataFrame, kind: str) -> DataFrame:
    """Ratio columns of a node table; ``kind`` is ``drive`` or ``walk``.

    ``nodes`` should be a stored table: it is scanned once per median pass.
    """
    ratios = {"drive": drive_ratios, "walk": walk_ratios}[kind]()
    new = {}
    for name, (above, below) in ratios.items():
        top = flag(F.col(above) > 0) if above in PRESENCE else F.col(above)
        new[name] = ratio(top, F.col(below))
    return fill_median(nodes.withColumns(new), list(new))
