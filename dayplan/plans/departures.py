"""Departure times by time-of-day code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayplan.functions.draws import digest, draw, open_uniform
from dayplan.functions.laws import between_knots, later_knots
from dayplan.functions.nulls import wrap_day
from dayplan.operators.order_stats import order_statistics
from dayplan.specs.departures import (
    EARLY_24,
    EARLY_24_SHARE,
    HOME_TO_WORK,
    LATE_24,
    WORK_TO_HOME,
)

LATER_22 = later_knots(HOME_TO_WORK[22], WORK_TO_HOME[22])


def early_24_test(persons: DataFrame, salt: str = "tod24") -> tuple[Column, int]:
    """A test on ``person_id`` that holds for exactly round(n 241/377) of the n persons with code 24.

    It takes the smallest hashed draws. Their threshold is an exact order statistic found by
    histogram passes; equal draws at the threshold are split by person id the same way, so
    no global sort or single-task ranking is needed.
    """
    drawn = draw(digest(salt, "person_id"))
    lot = persons.where(F.col("TOD") == 24).select("person_id", drawn.alias("lot"))
    n = lot.count()
    take = round(n * EARLY_24_SHARE[0] / EARLY_24_SHARE[1])
    if take == 0:
        return F.lit(False), n
    cut = int(order_statistics(lot, {"lot": [take - 1]})["lot"][0])
    below = lot.where(F.col("lot") < cut).count()
    tied = lot.where(F.col("lot") == cut)
    last_id = int(order_statistics(tied, {"person_id": [take - below - 1]})["person_id"][0])
    return (drawn < cut) | ((drawn == cut) & (F.col("person_id") <= last_id)), n


def early_24(persons: DataFrame, salt: str = "tod24") -> tuple[DataFrame, int]:
    """Persons with code 24 and the flag ``early`` of ``early_24_test``; their number."""
    test, n = early_24_test(persons, salt)
    return persons.where(F.col("TOD") == 24).select("person_id", test.alias("early")), n


def _by_code(laws: dict, u: Column) -> Column:
    out = None
    for code, law in laws.items():
        test = F.col("TOD") == code
        out = F.when(test, law.quantile(u)) if out is None else out.when(test, law.quantile(u))
    return out


def ordered_22(salt: str) -> Column:
    """Struct (hw, wh) drawn for code 22 given that home is left before work.

    Work is left by its law weighted with the chance that home was left earlier; then home
    is left by its own law up to that time. One draw each, so nothing is drawn again.
    """
    wh = between_knots(LATER_22, open_uniform(f"{salt}|again", "person_id", slot=0))
    hw = HOME_TO_WORK[22].quantile_before(open_uniform(f"{salt}|again", "person_id", slot=1), wh)
    return F.struct(hw.alias("hw"), wh.alias("wh"))


def departure_times(persons: DataFrame, salt: str = "depart") -> DataFrame:
    """(person_id, TOD, HW_ST, WH_ST) for every person with a time-of-day code.

    ``persons`` should be a stored table; it is scanned a few times for code 24.
    """
    coded = persons.where(F.col("TOD").isin(*WORK_TO_HOME)).select("person_id", "TOD")
    early, _ = early_24_test(coded, f"{salt}|24")
    coded = coded.withColumn("early", F.when(F.col("TOD") == 24, early))
    # both draws are columns of their own, as the quantile formulas use them many times
    coded = coded.withColumns(
        {
            "_u_hw": open_uniform(salt, "person_id", slot=0),
            "_u_wh": open_uniform(salt, "person_id", slot=1),
        }
    )
    u = F.col("_u_hw")
    hw = (
        F.when(F.col("early"), EARLY_24.quantile(u))
        .when(F.col("TOD") == 24, LATE_24.quantile(u))
        .otherwise(_by_code(HOME_TO_WORK, u))
    )
    wh = _by_code(WORK_TO_HOME, F.col("_u_wh"))
    drawn = coded.select("person_id", "TOD", hw.alias("hw"), wh.alias("wh"))
    # only the few pairs in the wrong order are drawn again
    wrong = (F.col("TOD") == 22) & (F.col("hw") >= F.col("wh"))
    fixed = drawn.withColumn("pair", F.when(wrong, ordered_22(salt)))
    return fixed.select(
        "person_id",
        "TOD",
        F.coalesce(F.col("pair.hw"), F.col("hw")).alias("HW_ST"),
        F.coalesce(
            F.col("pair.wh"),
            F.when(F.col("TOD").isin(14, 24), wrap_day(F.col("wh"))).otherwise(F.col("wh")),
        ).alias("WH_ST"),
    )
