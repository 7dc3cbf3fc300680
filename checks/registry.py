"""Named queries with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixtures import Model
from checks.oracle import statement
from dayplan.sources.readers import WIDE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, digits: int | None = None):
    """Register ``f(model) -> DataFrame`` under ``name``.

    Whole numbers come out as bigint. With ``digits``, doubles are rounded, because sums of
    doubles depend on their order; the SQL rounds the same way.
    """

    def wrap(f: Callable[[Model], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(f(Model(spark, folder)), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = statement(sql)
        return f

    return wrap


def plain(df: DataFrame, digits: int | None) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DoubleType) and digits is not None:
            c = F.round(c, digits)
        out.append(c.alias(f.name))
    return df.select(*out)


def as_text(df: DataFrame) -> DataFrame:
    """The table as a header-only CSV read would give it."""
    out = {c: F.col(c).cast("string") for c in df.columns}
    if len(out) >= WIDE:  # as in ``conform``
        out[df.columns[0]] = F.transform(F.array(F.col(df.columns[0])), lambda x: x.cast("string"))[0]
    return df.select(*[column.alias(c) for c, column in out.items()])
