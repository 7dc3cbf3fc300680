"""Readers: one table per entity, typed and keyed the same way for every format."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayplan.functions.nulls import clamp, ratio, zero_fill
from dayplan.operators.order_stats import exact_medians
from dayplan.specs import tables as spec

FORMATS = ("csv", "parquet")
WIDE = 32  # numbers of a row whose parsing, fused into one method, the JVM finds too long to compile


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unknown table format {fmt!r}; valid formats are {', '.join(FORMATS)}")
    return fmt


def declared_types(name: str) -> dict[str, str]:
    pairs = (part.strip().split(" ") for part in spec.COLUMNS[name].split(","))
    return {column: kind for column, kind in pairs}


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "csv") -> DataFrame:
    """Read one entity table from any path Spark can open (local, HDFS, object store)."""
    check_format(fmt)
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.csv(path, header=True)  # text first: no inference pass over the data
    return conform(raw, name)


def read_inputs(
    spark: SparkSession, folder: str, fmt: str = "csv", names: tuple[str, ...] | None = None
) -> dict[str, DataFrame]:
    """Read the named tables from a folder laid out with the standard file names."""
    check_format(fmt)
    chosen = names or tuple(n for n in spec.FILE_NAMES if n in spec.COLUMNS)
    return {
        n: read_table(spark, n, f"{folder.rstrip('/')}/{spec.FILE_NAMES[n]}.{fmt}", fmt)
        for n in chosen
    }


def conform(df: DataFrame, name: str) -> DataFrame:
    """Resolve the key, rename and cast to the declared types, then apply the table's rules."""
    df = _resolve_key(df, name)
    renames = {a: b for a, b in spec.RENAMES.get(name, {}).items() if a in df.columns}
    if renames:
        df = df.withColumnsRenamed(renames)
    df = df.drop(*spec.DROPS.get(name, ()))
    kinds = declared_types(name)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    chosen = {c: kinds.get(c) or ("double" if name in spec.MEASURE_TABLES and c in text else None) for c in df.columns}
    out = {c: _typed(F.col(f"`{c}`"), kind, c in text) for c, kind in chosen.items()}
    numbers = [c for c in df.columns if c in text and chosen[c] == "double"]
    if len(numbers) >= WIDE:  # a lambda is not fused with the other columns, and then the rest is compiled in parts
        out[numbers[0]] = F.transform(F.array(F.col(f"`{numbers[0]}`")), lambda x: x.try_cast("double"))[0]
    df = df.select(*[column.alias(c) for c, column in out.items()])
    rule = _RULES.get(name)
    return rule(df) if rule else df


def _resolve_key(df: DataFrame, name: str) -> DataFrame:
    if name not in spec.KEYS:
        return df
    key, others, first_column = spec.KEYS[name]
    if key in df.columns:
        return df
    for other in others:
        if other in df.columns:
            return df.withColumnRenamed(other, key)
    if first_column:
        return df.withColumnRenamed(df.columns[0], key)
    raise ValueError(f"table {name} has no key column {key}")


def _typed(column, kind: str | None, is_text: bool):
    if kind is None or (kind == "string" and is_text):
        return column
    if kind == "long":
        if not is_text:
            return column.cast("bigint")
        # files often hold whole numbers as 12.0
        return F.coalesce(column.try_cast("bigint"), column.try_cast("double").try_cast("bigint"))
    return column.try_cast(kind) if is_text else column.cast(kind)


def with_sqft_per_unit(buildings: DataFrame) -> DataFrame:
    """Residential area per unit; x/0 counts as 0 and 0/0 stays null."""
    area = ratio(F.col("residential_sqft"), F.col("residential_units"))
    return buildings.withColumn(
        "res_sqft_per_unit", F.when(area == float("inf"), F.lit(0.0)).otherwise(area)
    )


def winsorise_rentals(rentals: DataFrame) -> DataFrame:
    return rentals.withColumns(
        {
            "rent": clamp(F.col("rent"), 100.0, 10000.0),
            "rent_sqft": clamp(F.col("rent_sqft"), 0.2, 50.0),
        }
    )


def fill_access_indicators(df: DataFrame) -> DataFrame:
    """Pad the block code to 15 digits and fill each measure, where null or NaN, with its median."""
    measures = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
    ]
    medians = {c: m for c, m in exact_medians(df, measures).items() if m is not None}
    filled = [
        F.when(F.col(c).isNull() | F.isnan(c), F.lit(medians[c])).otherwise(F.col(c)).alias(c) if c in medians else F.col(c)
        for c in df.columns
        if c != "block_id"
    ]
    return df.select(zero_fill(F.col("block_id"), 15).alias("block_id"), *filled)


_RULES = {
    "buildings": with_sqft_per_unit,
    "rentals": winsorise_rentals,
    "access_indicators": fill_access_indicators,
}


def _is_missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def load_or_impute_skims(
    spark: SparkSession, folder: str, fmt: str = "csv", mtc: DataFrame | None = None
) -> DataFrame:
    """The stored imputed skims if present; otherwise impute them and store the result."""
    from dayplan.operators.skims import impute_skims

    check_format(fmt)
    base = folder.rstrip("/")
    stored = f"{base}/{spec.FILE_NAMES['beam_skims_imputed']}.{fmt}"
    try:
        return read_table(spark, "beam_skims_imputed", stored, fmt)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
    try:
        raw = read_table(spark, "beam_skims_raw", f"{base}/{spec.FILE_NAMES['beam_skims_raw']}.{fmt}", fmt)
        if mtc is None:
            mtc = read_table(spark, "mtc_skims", f"{base}/{spec.FILE_NAMES['mtc_skims']}.{fmt}", fmt)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        raise FileNotFoundError(
            f"{base} holds neither imputed skims nor the raw skims to impute them from"
        ) from error
    from dayplan.sources.writers import write_table

    write_table(impute_skims(mtc, raw), stored, fmt)
    return read_table(spark, "beam_skims_imputed", stored, fmt)
