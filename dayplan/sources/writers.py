"""Sinks: output tables, the archive, and the accessibility cache."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayplan.sources.readers import check_format, read_table
from dayplan.specs import tables as spec


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    check_format(fmt)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.parquet(path)


def write_outputs(
    tables: dict[str, DataFrame],
    path: str,
    fmt: str = "parquet",
    names: tuple[str, ...] = spec.OUTPUT_TABLES,
) -> list[str]:
    """Write every named table that is present; plans keep their order inside each file.

    Plans are range partitioned by person, so one person never spans two files.
    """
    check_format(fmt)
    written = []
    for name in names:
        if name not in tables:
            continue
        df = tables[name]
        if name == "plans":
            df = df.repartitionByRange("personId").sortWithinPartitions("personId", "planElementIndex")
            if fmt != "csv":
                write_table(df, f"{path}/{name}.csv", "csv")
        write_table(df, f"{path}/{name}.{fmt}", fmt)
        written.append(name)
    return written


def write_archive(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> list[str]:
    """The six population tables that a travel simulator takes as input."""
    return write_outputs(tables, path, fmt, spec.ARCHIVE_TABLES)


ACCESS_FILES = {
    "nodeswalk": spec.FILE_NAMES["nodeswalk"],
    "nodessmall": spec.FILE_NAMES["nodessmall"],
    "zones": spec.FILE_NAMES["zone_access_vars"],
}


def accessibility(
    spark: SparkSession,
    path: str,
    mode: str = "compute",
    build: Callable[[], dict[str, DataFrame]] | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Node and zone variables: ``compute`` builds and stores them, ``stored`` reads them.

    The returned ``zones`` table replaces the plain zones table.
    """
    check_format(fmt)
    if mode not in ("compute", "stored"):
        raise ValueError("mode must be 'compute' or 'stored'")
    if mode == "compute":
        if build is None:
            raise ValueError("compute mode needs a build function")
        built = build()
        for name, stem in ACCESS_FILES.items():
            write_table(built[name], f"{path}/{stem}.{fmt}", fmt)
    return {
        name: read_table(spark, name, f"{path}/{stem}.{fmt}", fmt)
        for name, stem in ACCESS_FILES.items()
    }
