"""Travel-time tables: imputation, accessibility sums, period views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dayplan.functions.nulls import finite, ratio
from dayplan.session import Scratch
from dayplan.specs.recodes import MODE_PERIODS, PERIODS

METERS_PER_MILE = 1609.34
MORNING_HOURS = [7, 8, 9]
OD = ["from_zone_id", "to_zone_id"]


def od_distances(mtc: DataFrame) -> DataFrame:
    """Drive distance of every zone pair in metres."""
    return mtc.select(
        F.col("orig").alias("from_zone_id"),
        F.col("dest").alias("to_zone_id"),
        (F.col("da_distance_AM") * METERS_PER_MILE).alias("dist"),
    )


def _needs_distance() -> Column:
    return (F.col("distanceInM") == 0) | (F.col("from_zone_id") == F.col("to_zone_id"))


def fix_distances(raw: DataFrame, mtc: DataFrame) -> DataFrame:
    """Observations with a zero or intrazonal distance take the drive distance."""
    return (
        raw.join(od_distances(mtc), OD, "left")
        .withColumn(
            "distanceInM",
            F.when(_needs_distance(), F.col("dist")).otherwise(F.col("distanceInM")),
        )
        .drop("dist")
    )


def morning_cells(raw: DataFrame) -> DataFrame:
    """Morning observations summed per (origin, destination, mode), weighted by count.

    One map-side-combined pass yields the weighted means and all that the mode rates
    need, so the observations themselves are never joined or moved: a pair that holds a
    large share of them is a single row afterwards. Rates of observations with their own
    distance are summed here; the rest are summed without a distance, which is the same
    for the whole pair and divides the sum later.
    """
    w = F.col("numObservations").cast("double")
    tt = finite(F.col("generalizedTimeInS") / 60)
    cost = finite(F.col("gen_cost"))
    own = ~F.coalesce(_needs_distance(), F.lit(False))
    own_tt = finite(ratio(tt, F.col("distanceInM")))
    own_cost = finite(ratio(cost, F.col("distanceInM")))
    both_own = own & own_tt.isNotNull() & own_cost.isNotNull()
    both_pair = ~own & tt.isNotNull() & cost.isNotNull()
    return (
        raw.where(F.col("hour").isin(MORNING_HOURS) & (F.col("numObservations") > 0))
        .groupBy(*OD, "mode")
        .agg(
            (F.sum(w * tt) / F.sum(F.when(tt.isNotNull(), w))).alias("gen_tt"),
            (F.sum(w * cost) / F.sum(F.when(cost.isNotNull(), w))).alias("gen_cost"),
            F.sum(F.when(both_own, w * own_tt)).alias("own_tt"),
            F.sum(F.when(both_own, w * own_cost)).alias("own_cost"),
            F.sum(F.when(both_own, w)).alias("own_w"),
            F.sum(F.when(both_pair, w * tt)).alias("pair_tt"),
            F.sum(F.when(both_pair, w * cost)).alias("pair_cost"),
            F.sum(F.when(both_pair, w)).alias("pair_w"),
        )
    )


def mode_rates(cells: DataFrame, mtc: DataFrame) -> DataFrame:
    """Weighted mean minutes and cost per metre of each mode."""
    d = F.col("dist")
    usable = d.isNotNull() & (d != 0) & F.col("pair_w").isNotNull()

    def part(own: str, pair: str) -> Column:
        shared = F.when(usable, F.col(pair) / d).otherwise(F.lit(0.0))
        return F.coalesce(F.col(own), F.lit(0.0)) + shared

    weight = F.coalesce(F.col("own_w"), F.lit(0.0)) + F.when(usable, F.col("pair_w")).otherwise(0.0)
    sums = (
        cells.where(F.col("mode").isNotNull())
        .join(od_distances(mtc), OD, "left")
        .groupBy("mode")
        .agg(
            F.sum(part("own_tt", "pair_tt")).alias("tt"),
            F.sum(part("own_cost", "pair_cost")).alias("cost"),
            F.sum(weight).alias("w"),
        )
        .where("w > 0")
    )
    return sums.select(
        "mode",
        (F.col("tt") / F.col("w")).alias("gen_time_per_m"),
        (F.col("cost") / F.col("w")).alias("gen_cost_per_m"),
    )


def morning_average(raw: DataFrame) -> DataFrame:
    """Weighted mean time and cost per (origin, destination, mode)."""
    return morning_cells(raw).select(*OD, "mode", "gen_tt", "gen_cost")


def pivot_modes(cells: DataFrame, modes: list[str]) -> DataFrame:
    """Long to wide: gen_tt_<mode> and gen_cost_<mode> per zone pair."""
    aggs = []
    for measure in ("gen_cost", "gen_tt"):
        for mode in modes:
            aggs.append(F.max(F.when(F.col("mode") == mode, F.col(measure))).alias(f"{measure}_{mode}"))
    return cells.groupBy(*OD).agg(*aggs)


def impute_skims(mtc: DataFrame, raw: DataFrame, modes: list[str] | None = None) -> DataFrame:
    """One row per pair of the full drive grid, with time and cost of every mode.

    A pair without morning observations of a mode gets distance times the mode's rate. The sums of
    pairs and modes are stored and moved to their zone pair once; they meet the drive grid in one join, which
    is stored and tells the rates as it is written. So the result is a projection of a stored table.
    """
    scratch = Scratch(mtc.sparkSession, "skims")
    cells = scratch.write(morning_cells(raw), "cells")
    if modes is None:
        modes = sorted(r["mode"] for r in cells.select("mode").distinct().collect() if r["mode"])
    grid = od_distances(mtc).select(*[F.col(c).alias(f"_{c}") for c in OD], "dist", F.lit(True).alias("_grid"))
    meet = [F.col(f"_{c}") == F.col(c) for c in OD]
    # pairs beside the grid count for the rates, as does each pair as often as the grid repeats it
    both = grid.join(_by_pair(cells, modes), meet, "full")
    kept = [f"{measure}_{mode}" for measure in ("gen_cost", "gen_tt") for mode in modes]
    seen = Observation()
    sums = [F.sum(c).alias(f"{part}_{i}") for i, mode in enumerate(modes) for part, c in _rate_parts(mode).items()]
    known = both.observe(seen, F.count("*").alias("n"), *sums).select(*[F.col(f"_{c}").alias(c) for c in OD], "dist", "_grid", *kept)
    stored = scratch.write(known, "pairs").where("_grid")
    totals = seen.get
    filled = []
    for part, measure in (("cost", "gen_cost"), ("tt", "gen_tt")):
        for i, mode in enumerate(modes):
            value = F.col(f"{measure}_{mode}")
            if (totals[f"w_{i}"] or 0) > 0:
                value = F.coalesce(value, F.col("dist") * F.lit(totals[f"{part}_{i}"] / totals[f"w_{i}"]))
            filled.append(value.alias(f"{measure}_{mode}"))
    return stored.select(*OD, "dist", *filled)


_SUMS = ("own_tt", "own_cost", "own_w", "pair_tt", "pair_cost", "pair_w")


def _by_pair(cells: DataFrame, modes: list[str]) -> DataFrame:
    """One row per zone pair with the means and sums of every mode side by side; rows move as they are, not spread out."""
    aggs = [
        F.max(F.when(F.col("mode") == mode, F.col(c))).alias(f"{c}_{mode}") for c in ("gen_cost", "gen_tt", *_SUMS) for mode in modes
    ]
    return cells.repartition(*OD).groupBy(*OD).agg(F.count("*").alias("_cells"), *aggs)


def _rate_parts(mode: str) -> dict[str, Column]:
    """What a zone pair adds to the weighted minutes and cost per metre of a mode, and the weight."""
    d = F.col("dist")
    usable = d.isNotNull() & (d != 0) & F.col(f"pair_w_{mode}").isNotNull()

    def part(own: str, pair: Column) -> Column:
        return F.coalesce(F.col(f"{own}_{mode}"), F.lit(0.0)) + F.when(usable, pair).otherwise(F.lit(0.0))

    return {
        "tt": part("own_tt", F.col(f"pair_tt_{mode}") / d), "cost": part("own_cost", F.col(f"pair_cost_{mode}") / d),
        "w": part("own_w", F.col(f"pair_w_{mode}")),
    }


@dataclass(frozen=True)
class SkimVariable:
    """Sum or mean of a destination value over the pairs cheaper than a cut-off."""

    name: str
    value: str
    impedance: str
    cutoff: float
    agg: str = "sum"
    log: bool = False


def standard_skim_variables() -> list[SkimVariable]:
    """The 18 zone accessibilities: two modes, four totals at 15 and 45, income at 30."""
    out = []
    for impedance in ("gen_tt_WALK_TRANSIT", "gen_tt_CAR"):
        for value in ("total_jobs", "sum_persons", "sum_income", "sum_residential_units"):
            for cutoff in (15, 45):
                out.append(SkimVariable(f"{value}_{impedance}_{cutoff}", value, impedance, cutoff))
        out.append(SkimVariable(f"avg_income_{impedance}_30", "avg_income", impedance, 30, "mean"))
    return out


def skim_access(zones: DataFrame, skims: DataFrame, specs: list[SkimVariable]) -> DataFrame:
    """All variables by one join and one shuffle; the own-zone value is added to each."""
    values = sorted({s.value for s in specs})
    impedances = sorted({s.impedance for s in specs})
    dest = zones.select(F.col("zone_id").alias("to_zone_id"), *values)
    aggs = []
    for s in specs:
        inside = F.when(F.col(s.impedance) < s.cutoff, F.col(s.value).cast("double"))
        aggs.append((F.sum(inside) if s.agg == "sum" else F.avg(inside)).alias(f"_{s.name}"))
    reach = (
        skims.select(*OD, *impedances)
        .join(dest, "to_zone_id")
        .groupBy(F.col("from_zone_id").alias("zone_id"))
        .agg(*aggs)
    )
    out = []
    for s in specs:
        total = F.coalesce(F.col(f"_{s.name}"), F.lit(0.0)) + F.col(s.value)
        out.append((F.log1p(total) if s.log else total).alias(s.name))
    return zones.join(reach, "zone_id", "left").select(*[zones[c] for c in zones.columns], *out)


def period_columns(columns: list[str], period: str) -> dict[str, str]:
    """Skim columns of one period, by ending, mapped to their name without the period."""
    out = {}
    for c in columns:
        if c.endswith(f"_{period}"):
            bare = c[: -len(period) - 1]
            for measure in ("distance", "cost"):
                if bare.endswith(f"_{measure}"):
                    bare = bare[: -len(measure)] + measure.capitalize()
            out[c] = bare
    return out


def skims_by_period(mtc: DataFrame, periods: tuple[str, ...] = MODE_PERIODS) -> DataFrame:
    """Wide to long by period from one scan: one row per (orig, dest, period).

    A measure that a period does not have is null there.
    """
    by_period = {p: {b: a for a, b in period_columns(mtc.columns, p).items()} for p in periods}
    measures = sorted({m for names in by_period.values() for m in names})

    def pick(period: str, measure: str) -> Column:
        source = by_period[period].get(measure)
        value = F.col(source) if source else F.lit(None)
        return value.cast("double").alias(measure)

    structs = [
        F.struct(F.lit(p).alias("TOD"), *[pick(p, m) for m in measures]) for p in periods
    ]
    return mtc.select("orig", "dest", F.explode(F.array(*structs)).alias("s")).select(
        "orig", "dest", "s.*"
    )


def round_trip_times(
    mtc: DataFrame, periods: tuple[str, ...] = PERIODS, wanted: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """da_Time_{out}_{back} for every zone pair: out on (orig, dest), back on (dest, orig).

    The table is joined with itself, so the far longer persons table needs one join. ``wanted`` leaves out zone
    pairs (orig, dest) that nobody asks for: from both sides, before they move.
    """
    out = mtc.select("orig", "dest", *[F.col(f"da_Time_{p}").alias(f"_hw_{p}") for p in periods])
    back = mtc.select(
        F.col("dest").alias("orig"),
        F.col("orig").alias("dest"),
        *[F.col(f"da_Time_{p}").alias(f"_wh_{p}") for p in periods],
    )
    if wanted:
        out, back = wanted(out), wanted(back)
    both = out.join(back, ["orig", "dest"], "left")
    pairs = [
        (F.col(f"_hw_{a}") + F.col(f"_wh_{b}")).alias(f"da_Time_{a}_{b}")
        for a in periods
        for b in periods
    ]
    return both.select("orig", "dest", *pairs)
