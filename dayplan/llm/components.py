"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.llm.shared import Scratch


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link neighbours to the least one near each vertex: larger ones, or smaller ones and itself."""
    both = edges if small else edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m"))
    near = both.join(least, F.col("a") == F.col("u"))
    if small:
        linked = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        linked = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.where("a <> b").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) of every vertex of ``edges`` (a bigint, b bigint) but the roots; root is the least id.

    Each round writes its edges, so a lost executor costs one round. Vertices of high degree are
    reduced to their least neighbour before the join, which the adaptive planner splits.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, mark, turn = scratch.write(now, "edges-0"), None, 0
    while True:
        row = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("h"),
                      F.sum(F.expr("cast(xxhash64(b, a) as decimal(38, 0))")).alias("s")).first()
        if tuple(row) == mark or not row["n"]:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
        mark, turn = tuple(row), turn + 1
        large = scratch.write(_star(now, small=False), f"edges-{turn}-large")
        now = scratch.write(_star(large, small=True), f"edges-{turn}")
