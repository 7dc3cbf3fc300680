"""Activity and leg rows of each commuter's day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayplan.operators.relations import merge_tables

PLAN_COLUMNS = ["personId", "planElement", "planElementIndex", "activityType", "x", "y", "endTime"]


def trip_table(tables: dict[str, DataFrame]) -> DataFrame:
    """Person, times of leaving home and work, and both coordinates."""
    work = merge_tables(tables, "jobs", ["jobs", "buildings", "parcels"], ["job_id", "x", "y"])
    home = merge_tables(
        tables, "households", ["households", "units", "buildings", "parcels"],
        ["household_id", "x", "y"],
    )
    return (
        tables["persons"]
        .select(
            "person_id", "household_id", "job_id",
            F.col("HW_ST").alias("Home"), F.col("WH_ST").alias("Work"),
        )
        .join(home.withColumnsRenamed({"x": "x_home", "y": "y_home"}), "household_id")
        .join(work.withColumnsRenamed({"x": "x_work", "y": "y_work"}), "job_id")
        .select("person_id", "Home", "Work", "x_home", "y_home", "x_work", "y_work")
    )


def _element(index: int, kind: str, activity: Column, x: Column, y: Column, end: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("planElement"),
        F.lit(index).cast("bigint").alias("planElementIndex"),
        activity.alias("activityType"),
        x.alias("x"),
        y.alias("y"),
        end.cast("double").alias("endTime"),
    )


def activity_plans(trips: DataFrame) -> DataFrame:
    """Five rows per trip: first activity, leg, second activity, leg, first activity again.

    The two activities are ordered inside the row by end time (unknown last, ties start at
    home), so the whole plan is a projection: no shuffle, sort or window.
    """
    home, work = F.col("Home"), F.col("Work")
    work_first = F.coalesce(work < home, home.isNull() & work.isNotNull())

    def pick(at_work: Column, at_home: Column) -> tuple[Column, Column]:
        return F.when(work_first, at_work).otherwise(at_home), F.when(work_first, at_home).otherwise(at_work)

    kinds = pick(F.lit("Work"), F.lit("Home"))
    xs = pick(F.col("x_work"), F.col("x_home"))
    ys = pick(F.col("y_work"), F.col("y_home"))
    ends = pick(work, home)
    nothing = F.lit(None).cast("double")
    rows = F.array(
        _element(1, "activity", kinds[0], xs[0], ys[0], ends[0]),
        _element(2, "leg", F.lit(""), nothing, nothing, nothing),
        _element(3, "activity", kinds[1], xs[1], ys[1], ends[1]),
        _element(4, "leg", F.lit(""), nothing, nothing, nothing),
        _element(5, "activity", kinds[0], xs[0], ys[0], nothing),
    )
    return trips.select(F.col("person_id").alias("personId"), F.explode(rows).alias("e")).select(
        "personId", "e.*"
    ).select(*PLAN_COLUMNS)
