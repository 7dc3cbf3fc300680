"""A gap-free row number over a whole table, without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.session import materialize

_ROW_BITS = 33  # rows per partition in monotonically_increasing_id


def dense_index(df: DataFrame, *order: str, name: str = "idx") -> tuple[DataFrame, int]:
    """Add ``name`` = 0, 1, 2, ... in ``order``; returns the table and its row count.

    The sort is range partitioned. Only one row count per partition reaches the
    driver; they become the offsets.
    """
    stamp = materialize(
        df.orderBy(*order).withColumn("_rid", F.monotonically_increasing_id()), "index"
    )
    part = F.shiftright("_rid", _ROW_BITS)
    counts = sorted(
        (r["p"], r["n"]) for r in stamp.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()
    )
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((int(p), int(total)))
        total += n
    spark = df.sparkSession
    within = F.col("_rid").bitwiseAND((1 << _ROW_BITS) - 1)
    if len(offsets) <= 1:
        return stamp.withColumn(name, within).drop("_rid"), total
    table = spark.createDataFrame(offsets, "_part long, _start long")
    out = (
        stamp.withColumn("_part", part)
        .join(F.broadcast(table), "_part")  # one row per partition
        .withColumn(name, within + F.col("_start"))
        .drop("_rid", "_part", "_start")
    )
    return out, total
