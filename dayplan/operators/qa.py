"""Coverage rates and table profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.specs.choice import WORKER_FILTERS


def coverage(
    persons: DataFrame, households: DataFrame, modes: DataFrame, plans: DataFrame
) -> DataFrame:
    """(step, covered, total, percent) of each pipeline step.

    ``persons`` carries zone_id_home. Every table is read by one aggregate.
    """
    workers = reduce(lambda a, b: a & b, [F.expr(p) for p in WORKER_FILTERS])
    placed = F.col("job_id").isNotNull()
    p = persons.agg(
        F.count(F.when(placed, 1)).alias("placed"),
        F.count(F.when(workers, 1)).alias("workers"),
        F.count(F.when(F.col("HW_ST").isNotNull(), 1)).alias("departures"),
    )
    h = households.agg(
        F.count(F.when(F.col("cars").isNotNull(), 1)).alias("with_cars"),
        F.count("*").alias("households"),
    )
    m = modes.agg(F.count(F.when(F.col("primary_commute_mode").isNotNull(), 1)).alias("with_mode"))
    # each planned person has one row with index 1
    q = plans.agg(F.count(F.when(F.col("planElementIndex") == 1, 1)).alias("planned"))
    parts = [
        p.select(F.explode(F.array(
            F.struct(F.lit("workplace").alias("step"), F.col("placed").alias("covered"),
                     F.col("workers").alias("total")),
            F.struct(F.lit("departure").alias("step"), F.col("departures").alias("covered"),
                     F.col("placed").alias("total")),
        )).alias("r")).select("r.*"),
        h.select(F.lit("autos").alias("step"), F.col("with_cars").alias("covered"),
                 F.col("households").alias("total")),
        m.select(F.lit("mode").alias("step"), F.col("with_mode").alias("covered"),
                 F.lit(None).cast("bigint").alias("total")),
        q.select(F.lit("plans").alias("step"), F.col("planned").alias("covered"),
                 F.lit(None).cast("bigint").alias("total")),
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    # the last two are shares of the persons with a job
    with_job = p.select("placed").scalar()
    total = F.coalesce(F.col("total"), with_job)
    percent = F.when(total > 0, F.round(F.col("covered") / total * 100, 1))
    return stacked.select("step", "covered", total.alias("total"), percent.alias("percent"))


PROFILE = ("count", "mean", "stddev", "min", "max")


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with count, mean, deviation and range, from one aggregate."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        stats = (F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("stddev"),
                 F.min(v).alias("min"), F.max(v).alias("max"))
        aggs.append(F.struct(F.lit(c).alias("column"), *stats).alias(c))
    return df.agg(*aggs).select(F.explode(F.array(*[F.col(c) for c in columns])).alias("r")).select("r.*")


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Spark's own summary, with approximate quartiles, for interactive use."""
    return df.select(*columns).summary() if columns else df.summary()
