"""Stored steps of a run, so that a run that was cut off goes on behind its last finished step.

A step is written into a folder of its own; only then a row naming that folder joins the list of
steps, in one file. A step that was cut off is not in the list and its folder is never looked at.
Steps are found again by their key, which stands for the inputs and settings of the run.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayplan.session import Scratch
from dayplan.sources.readers import WIDE

LISTED = "key string, step string, folder string"


def fingerprint(tables: dict[str, DataFrame], settings: dict[str, object]) -> str:
    """Stands for the rows of ``tables``, whatever their order and partitioning, and for ``settings``.

    One scan of each table with one row per task moved: the number of rows, and the sum and the
    exclusive or of their hashes. Each value is hashed by itself, so that an unknown one keeps its place;
    zeros of either sign are equal.
    """
    def value(df: DataFrame, c: str) -> Column:
        nested = isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType))  # as text: maps have no hash
        return F.xxhash64(F.to_json(F.struct(F.col(f"`{c}`").alias("c"))) if nested else F.col(f"`{c}`"))

    def summary(name: str, df: DataFrame) -> DataFrame:
        columns = sorted(df.columns)
        values = [value(df, c) for c in columns]
        if len(values) >= WIDE:  # a lambda is not fused with the other columns, and then the rest is compiled in parts
            values[0] = F.transform(F.array(F.col(f"`{columns[0]}`")), lambda x: F.xxhash64(x))[0]
        return df.select(F.xxhash64(*values).alias("h")).agg(
            F.lit(name).alias("name"), F.lit(json.dumps([(c, df.schema[c].dataType.simpleString()) for c in columns])).alias("columns"),
            F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("sum"), F.bit_xor("h").alias("xor"))

    parts = [summary(name, df) for name, df in sorted(tables.items())]
    rows = sorted(map(tuple, reduce(DataFrame.unionByName, parts).collect())) if parts else []  # a row per table
    return hashlib.sha256(json.dumps([rows, sorted(settings.items())]).encode()).hexdigest()


class Steps:
    """Steps stored under ``path`` for ``key``; without a path, under the scratch folder and for this run only."""

    def __init__(self, spark: SparkSession, path: str | None = None, key: str = ""):
        self.spark, self.key, self.listed = spark, key, path is not None
        self.path = path or Scratch(spark, "run").root
        self.done = self._done() if self.listed else {}
        self._listing = threading.Lock()  # steps may be built side by side, the list is written by one at a time

    def _done(self) -> dict[str, str]:
        try:
            rows = self.spark.read.schema(LISTED).parquet(f"{self.path}/steps").where(F.col("key") == self.key).collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return {}
        return {r["step"]: r["folder"] for r in rows}  # a row per step of one run

    def table(self, step: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored table of ``step``; ``build`` is called only if there is none."""
        if step not in self.done:
            folder = f"{step}-{uuid.uuid4().hex}"
            build().write.parquet(f"{self.path}/{folder}")
            if self.listed:
                with self._listing:
                    row = self.spark.createDataFrame([(self.key, step, folder)], LISTED)
                    row.coalesce(1).write.mode("append").parquet(f"{self.path}/steps")
            self.done[step] = folder
        return self.spark.read.parquet(f"{self.path}/{self.done[step]}")
