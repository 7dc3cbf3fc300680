"""Zone totals. Facts are summed per building before any join, so a crowded building,
parcel or zone is one row by the time rows move."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.operators.relations import building_zones

TOTALS = ("total_jobs", "sum_residential_units", "sum_persons", "sum_income")


def zone_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Jobs, residential units, persons and income per zone; absent is 0."""
    zones = tables["zones"].select("zone_id")
    of_building = building_zones(tables["buildings"], tables["parcels"])
    people = tables["households"].groupBy("building_id").agg(
        F.sum("persons").alias("sum_persons"), F.sum("income").alias("sum_income")
    )
    jobs = tables["jobs"].groupBy("building_id").agg(F.count("*").alias("total_jobs"))
    units = tables["buildings"].select(
        "building_id", F.col("residential_units").alias("sum_residential_units")
    )
    sums = (
        of_building.join(units, "building_id")
        .join(people, "building_id", "left")
        .join(jobs, "building_id", "left")
        .where(F.col("zone_id").isNotNull())
        .groupBy("zone_id")
        .agg(*[F.sum(c).alias(c) for c in TOTALS])
    )
    return (
        zones.join(sums, "zone_id", "left")
        .select("zone_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in TOTALS])
        .withColumn("total_jobs", F.col("total_jobs").cast("bigint"))
    )


def zone_avg_income(tables: dict[str, DataFrame]) -> DataFrame:
    """Mean over parcels of the mean over buildings of the mean household income."""
    per_building = (
        tables["households"]
        .where(F.col("building_id").isNotNull())
        .groupBy("building_id")
        .agg(F.avg("income").alias("m"))
    )
    per_parcel = (
        per_building.join(tables["buildings"].select("building_id", "parcel_id"), "building_id")
        .where(F.col("parcel_id").isNotNull())
        .groupBy("parcel_id")
        .agg(F.avg("m").alias("m"))
    )
    per_zone = (
        per_parcel.join(tables["parcels"].select("parcel_id", "zone_id"), "parcel_id")
        .where(F.col("zone_id").isNotNull())
        .groupBy("zone_id")
        .agg(F.avg("m").alias("avg_income"))
    )
    return (
        tables["zones"].select("zone_id").join(per_zone, "zone_id", "left")
        .select("zone_id", F.coalesce(F.col("avg_income"), F.lit(0.0)).alias("avg_income"))
    )


def zone_variables(tables: dict[str, DataFrame]) -> DataFrame:
    """Totals and average income in one table."""
    return zone_totals(tables).join(zone_avg_income(tables), "zone_id")
