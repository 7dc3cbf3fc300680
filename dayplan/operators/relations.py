"""Joins along the foreign keys of the data model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayplan.session import Scratch, materialize
from dayplan.specs.tables import RELATIONS


def lookup(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, columns: list[str] | dict[str, str]
) -> DataFrame:
    """Left lookup of parent columns; a missing parent gives null. ``pk`` must be unique.

    No hint is given: the adaptive planner broadcasts the parent when its measured size
    is small and splits skewed partitions of the child when it is not.
    """
    names = columns if isinstance(columns, dict) else {c: c for c in columns}
    taken = [F.col(pk).alias("_pk"), *[F.col(a).alias(b) for a, b in names.items()]]
    kept = child.drop(*[b for b in names.values() if b in child.columns])
    return kept.join(parent.select(*taken), F.col(fk) == F.col("_pk"), "left").drop("_pk")


PART_ROWS = 100_000  # rows of one key that a task takes at once, at least
MOST_HEAVY = 10_000  # keys that are cut into parts, at most
MOST_BITS = 1 << 28  # bits that mark the keys that a table is asked for
_BITS = 1 << 15  # bits of one bitmap


def pair_lookup(
    rows: DataFrame, table: DataFrame | Callable[[Callable[[DataFrame], DataFrame]], DataFrame], on: dict[str, str]
) -> DataFrame:
    """Left join of ``rows`` with ``table``, whose keys are unique; ``on`` maps key columns of rows to those of table.

    A key may hold any share of the rows: they are counted by key, every key above a bound is cut into
    parts, and its table row is repeated for each part, so no task depends on one key. The bound lets at
    most ``MOST_HEAVY`` keys be cut, which is what makes their list small enough to broadcast. Rows with
    a null in the key match nothing and are dealt out one by one. The rows are stored first: counting
    and joining do not repeat what made them. Rows of the table that no row asks for are left out before
    they move. A column of both sides keeps the value of ``rows``.

    A table that is itself made by joins on the key may be given as a function: it gets a filter that does the
    same to any table with the key columns, so that its own joins move no more than is asked for.
    """
    scratch = Scratch(rows.sparkSession, "pairs")
    stored, n = scratch.write_counting(rows, "rows")
    bound = max(PART_ROWS, n // MOST_HEAVY)
    keys = [F.col(c).cast(stored.schema[r].dataType).alias(r) for r, c in on.items()]
    known = F.expr(" and ".join(f"`{r}` is not null" for r in on))
    heavy = F.broadcast(scratch.write(
        stored.where(known).groupBy(*on).count().where(F.col("count") > bound)
        .select(*on, F.ceil(F.col("count") / bound).alias("_parts")), "heavy"))
    number = F.monotonically_increasing_id()
    dealt = stored.withColumn("_row", number).join(heavy, list(on), "left").withColumn(
        "_part", F.when(known, F.pmod("_row", F.coalesce("_parts", F.lit(1)))).otherwise(F.col("_row")))
    asked = stored.where(known)
    made = callable(table)
    if made:
        table = table(lambda df: _wanted(df, asked, list(on), n, keys))
    kept = [c for c in table.columns if c not in rows.columns and c not in on.values()]
    narrow = table.select(*keys, *kept)
    repeated = (narrow if made else _wanted(narrow, asked, list(on), n)).join(heavy, list(on), "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return dealt.join(repeated, [*on, "_part"], "left").select(*[F.col(f"`{c}`") for c in (*rows.columns, *kept)])


def _wanted(table: DataFrame, rows: DataFrame, on: list[str], n: int, keys: list[Column] | None = None) -> DataFrame:
    """The rows of ``table`` whose keys (``on``, if not given) occur in ``rows``, and a few more: what may go before a join.

    The keys' hashes are marked in bits, some 16 for each of the ``n`` rows, at most ``MOST_BITS`` in all (32 MB);
    they are handed to every task, so the table does not move to be filtered.
    """
    bits = max(_BITS, min(MOST_BITS, 1 << (16 * n).bit_length()))

    def place(key: list) -> dict[str, Column]:
        mark = F.pmod(F.xxhash64(*key), F.lit(bits))
        return {"_bucket": F.shiftright(mark, 15), "_bit": F.pmod(mark, F.lit(_BITS))}

    marks = rows.select(*[c.alias(name) for name, c in place(on).items()]).groupBy("_bucket").agg(
        F.bitmap_construct_agg("_bit").alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright("_bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.expr("shiftright(_byte, cast(_bit % 8 as int)) % 2 = 1")
    return (
        table.withColumns(place(keys or on)).join(F.broadcast(marks), "_bucket")
        .withColumn("_byte", byte).where(marked).select(*table.columns)
    )


def merge_tables(
    tables: dict[str, DataFrame], target: str, names: list[str], columns: list[str] | None = None
) -> DataFrame:
    """Inner joins from ``target`` to every named table that its keys lead to.

    Parents are merged first, so the long child table is joined once per key. When a
    column name occurs twice, the table nearer to the target keeps it.
    """
    merged, used = _merge(tables, target, set(names))
    missing = set(names) - used
    if missing:
        raise ValueError(f"no key leads from {target} to {sorted(missing)}")
    return merged.select(*columns) if columns else merged


def _merge(tables: dict[str, DataFrame], child: str, names: set[str]) -> tuple[DataFrame, set[str]]:
    df, used = tables[child], {child}
    for parent, owner, fk, pk in RELATIONS:
        if owner != child or parent not in names or fk not in df.columns:
            continue
        right, below = _merge(tables, parent, names)
        kept = [F.col(c) for c in right.columns if c not in df.columns and c != pk]
        right = right.select(F.col(pk).alias("_pk"), *kept)
        df = df.join(right, F.col(fk) == F.col("_pk"), "inner").drop("_pk")
        used |= below
    return df, used


def update_column(df: DataFrame, key: str, values: DataFrame, column: str) -> DataFrame:
    """Overwrite ``column`` where ``values`` has the key, with null too; other rows keep what they had."""
    new = values.select(F.col(key), F.col(column).alias("_new"), F.lit(True).alias("_there"))
    old = F.col(column) if column in df.columns else F.lit(None)
    joined = df.join(new, key, "left")
    return joined.withColumn(column, F.when(F.col("_there"), F.col("_new")).otherwise(old)).drop("_new", "_there")


def complement(df: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``part``."""
    return df.join(part.select(key), key, "left_anti")


def filter_all(df: DataFrame, predicates: list[str] | None) -> DataFrame:
    """Keep the rows that pass every SQL predicate."""
    for predicate in predicates or []:
        df = df.where(predicate)
    return df


def building_zones(buildings: DataFrame, parcels: DataFrame) -> DataFrame:
    """building_id with the zone of its parcel (buildings on no parcel are left out)."""
    return buildings.select("building_id", "parcel_id").join(
        parcels.select("parcel_id", "zone_id"), "parcel_id"
    ).select("building_id", "zone_id")


def add_zone_id_work(jobs: DataFrame, buildings: DataFrame, parcels: DataFrame) -> DataFrame:
    zones = building_zones(buildings, parcels)
    out = lookup(jobs, "building_id", zones, "building_id", {"zone_id": "zone_id_work"})
    return out.withColumn("zone_id_work", F.col("zone_id_work").cast("double"))


def household_zones(
    households: DataFrame, units: DataFrame, buildings: DataFrame, parcels: DataFrame
) -> DataFrame:
    """household_id with the zone reached through its unit and that unit's building."""
    unit_zones = units.select("unit_id", "building_id").join(
        building_zones(buildings, parcels), "building_id"
    )
    return households.select("household_id", "unit_id").join(unit_zones, "unit_id").select(
        "household_id", "zone_id"
    )


def add_zone_id_home(
    persons: DataFrame,
    households: DataFrame,
    units: DataFrame,
    buildings: DataFrame,
    parcels: DataFrame,
) -> DataFrame:
    zones = household_zones(households, units, buildings, parcels)
    out = lookup(persons, "household_id", zones, "household_id", {"zone_id": "zone_id_home"})
    return out.withColumn("zone_id_home", F.col("zone_id_home").cast("double"))


def propagate_node_ids(
    tables: dict[str, DataFrame], node_columns: list[str], store: bool = True
) -> dict[str, DataFrame]:
    """Carry parcel node ids to buildings, units, households, persons and jobs.

    Each level reads a narrow (key, node ids) table of the level above. With ``store`` these
    are written once, so a lower level does not repeat the joins of the upper ones.
    """
    steps = (
        ("buildings", "parcel_id", "parcels", "parcel_id"),
        ("units", "building_id", "buildings", "building_id"),
        ("households", "unit_id", "units", "unit_id"),
        ("persons", "household_id", "households", "household_id"),
        ("jobs", "building_id", "buildings", "building_id"),
    )
    out = dict(tables)
    narrow: dict[str, DataFrame] = {}
    for child, fk, parent, pk in steps:
        if child not in out:
            continue
        if parent not in narrow:
            ids = out[parent].select(pk, *node_columns)
            narrow[parent] = materialize(ids, f"ids-{parent}") if store else ids
        out[child] = lookup(out[child], fk, narrow[parent], pk, node_columns)
    return out
