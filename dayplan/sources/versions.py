"""Published outputs: every run writes aside and becomes visible at once.

A run writes its tables into a folder of its own. Only then one row per table is appended to the
manifest, in one file, so the tables of a run appear together or not at all; a run that was cut off
leaves the last published version readable, and its folder is never looked at.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayplan.sources.readers import check_format
from dayplan.sources.writers import write_outputs
from dayplan.specs import tables as spec

MANIFEST = "version bigint, name string, folder string, fmt string, rows bigint"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(version, name, folder, fmt, rows) of everything that was ever published under ``path``."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], MANIFEST)


def publish(
    spark: SparkSession, tables: dict[str, DataFrame], path: str, fmt: str = "parquet",
    names: tuple[str, ...] = spec.OUTPUT_TABLES,
) -> int:
    """Write the named tables that are present and make them the newest version; returns its number.

    Runs that publish to one path at the same time need numbers of their own: publish from one driver.
    """
    check_format(fmt)
    newest = manifest(spark, path).agg(F.max("version")).first()[0] or 0
    folder = f"versions/{newest + 1:06d}-{uuid.uuid4().hex[:8]}"
    written = write_outputs(tables, f"{path}/{folder}", fmt, names)
    rows = [(newest + 1, name, folder, fmt, _read(spark, f"{path}/{folder}/{name}.{fmt}", fmt).count()) for name in written]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return newest + 1


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return spark.read.parquet(path) if fmt == "parquet" else spark.read.csv(path, header=True)


def published(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version, of the newest if none is given."""
    rows = manifest(spark, path)
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    found = rows.where(F.col("version") == F.lit(version)).collect()  # a row per table
    if not found:
        raise FileNotFoundError(f"{path} holds no published version {version or ''}".rstrip())
    return {r["name"]: _read(spark, f"{path}/{r['folder']}/{r['name']}.{r['fmt']}", r["fmt"]) for r in found}


def out_of_order(stored: DataFrame, key: str, place: str) -> int:
    """Rows of a stored parquet table that do not follow the row before them in their file by (key, place),
    and keys that lie in several files.

    Neighbours meet by file and row number, so no file is gathered in one window.
    """
    rows = stored.select(F.col(key).alias("k"), F.col(place).alias("p"), F.col("_metadata.file_path").alias("f"),
                         F.col("_metadata.row_index").alias("i"))
    after = rows.select("f", (F.col("i") - 1).alias("i"), F.col("k").alias("k2"), F.col("p").alias("p2"))
    wrong = rows.join(after, ["f", "i"]).where("k > k2 or (k = k2 and p >= p2)").count()
    split = rows.groupBy("k").agg(F.min("f").alias("a"), F.max("f").alias("b")).where("a <> b").count()
    return wrong + split
