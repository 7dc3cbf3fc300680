"""A many-to-one join that a key with a third of the rows does not slow down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY = 4096  # keys that hold at least this fraction of all rows are broadcast; there are at most so many


def join_facts(rows: DataFrame, facts: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """``rows`` (stored) inner joined with ``facts``, one row per key ``on``.

    ``weight`` is the number of ``rows`` of a key, ``total`` that of all keys. Keys with a 4096th of
    the rows or more are at most 4096, whatever the data, and are broadcast, so their rows stay where
    they are; the others are shuffled, and none of them makes a large task.
    """
    heavy = F.col(weight) * HEAVY >= F.lit(total)
    few = facts.where(heavy)
    light = rows.join(F.broadcast(few.select(*on)), on, "left_anti").join(facts.where(~heavy), on)
    return rows.join(F.broadcast(few), on).unionByName(light)
