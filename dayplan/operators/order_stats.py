"""Exact order statistics of whole columns without a global sort or one big group.

Each pass is one map-side-combined aggregate. A search keeps the value range that
holds the wanted rank and narrows it with a fixed-width histogram until a single
value is left. The least and the largest value of a range never share a bin, so every
pass gets on; neither a task nor the driver ever holds more than the bins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.functions.nulls import INF

BINS = 4096


@dataclass
class _Search:
    column: str
    rank: int  # zero-based rank inside [low, high]
    low: float
    high: float
    value: float | None = None


def order_statistics(
    df: DataFrame, ranks: dict[str, list[int]], bins: int = BINS
) -> dict[str, list[float]]:
    """Zero-based order statistics of numeric columns; nulls and NaN are skipped."""
    stats = _column_stats(df, list(ranks))
    return _select(df, {c: (stats[c], r) for c, r in ranks.items()}, bins)


def exact_medians(
    df: DataFrame, columns: list[str], bins: int = BINS
) -> dict[str, float | None]:
    """Median per column; infinities take part as the largest or smallest values."""
    stats = _column_stats(df, columns)
    wanted = {}
    for c in columns:
        n = sum(stats[c][k] for k in ("neg", "fin", "pos"))
        if n:
            wanted[c] = (stats[c], [(n - 1) // 2, n // 2])
    found = _select(df, wanted, bins)
    out: dict[str, float | None] = {}
    for c in columns:
        pair = found.get(c)
        if pair is None:
            out[c] = None
        else:
            low, high = pair
            out[c] = low if low == high else low + (high - low) / 2
    return out


def _column_stats(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        known = v.isNotNull() & ~F.isnan(v)
        inner = F.when(known & (v > -INF) & (v < INF), v)
        aggs += [
            F.count(F.when(known & (v == -INF), 1)).alias(f"neg{i}"),
            F.count(F.when(known & (v == INF), 1)).alias(f"pos{i}"),
            F.count(inner).alias(f"fin{i}"),
            F.min(inner).alias(f"min{i}"),
            F.max(inner).alias(f"max{i}"),
        ]
    row = df.agg(*aggs).first()
    return {
        c: {k: row[f"{k}{i}"] for k in ("neg", "pos", "fin", "min", "max")}
        for i, c in enumerate(columns)
    }


def _select(df: DataFrame, wanted: dict, bins: int) -> dict[str, list[float]]:
    searches: list[_Search] = []
    slots: dict[str, list[_Search]] = {}
    for c, (stat, ranks) in wanted.items():
        slots[c] = []
        by_rank: dict[int, _Search] = {}
        for rank in ranks:
            if rank not in by_rank:
                s = _Search(c, rank - stat["neg"], stat["min"], stat["max"])
                if rank < stat["neg"]:
                    s.value = -INF
                elif s.rank >= stat["fin"]:
                    s.value = INF
                elif s.low == s.high:
                    s.value = s.low
                by_rank[rank] = s
                searches.append(s)
            slots[c].append(by_rank[rank])
    open_searches = [s for s in searches if s.value is None]
    while open_searches:
        _narrow(df, open_searches, bins)
        open_searches = [s for s in searches if s.value is None]
    return {c: [s.value for s in found] for c, found in slots.items()}


def _inside(s: _Search):
    v = F.col(s.column).cast("double")
    return v, (v >= s.low) & (v <= s.high)


def _narrow(df: DataFrame, searches: list[_Search], bins: int) -> None:
    """One histogram pass; the bin that holds the rank becomes the new range."""
    cells = []
    for i, s in enumerate(searches):
        v, inside = _inside(s)
        # scale each end first, so that a range wider than the double maximum stays finite
        step = s.high / bins - s.low / bins
        if step > 0:
            at = (v / F.lit(float(bins)) - F.lit(s.low / bins)) / F.lit(step) * F.lit(float(bins))
            # the rounding of the scale must not push a value out, nor the largest into the first bin
            bin_no = F.when(v == s.high, F.lit(bins - 1)).otherwise(
                F.greatest(F.lit(0), F.least(F.lit(bins - 2 if bins > 2 else 0), F.floor(at).cast("int"))))
        else:  # the range is too narrow to be divided: its least value and the rest
            bin_no = F.when(v == s.low, F.lit(0)).otherwise(F.lit(1))
        cells.append(
            F.when(inside, F.struct(F.lit(i).alias("i"), bin_no.alias("b"), v.alias("v")))
        )
    rows = (
        df.select(F.explode(F.array(*cells)).alias("c"))
        .where("c is not null")
        .groupBy("c.i", "c.b")
        .agg(F.count("*").alias("n"), F.min("c.v").alias("lo"), F.max("c.v").alias("hi"))
        .collect()  # at most bins rows per search
    )
    for i, s in enumerate(searches):
        left = s.rank
        for r in sorted((r for r in rows if r["i"] == i), key=lambda r: r["b"]):
            if left < r["n"]:
                s.rank, s.low, s.high = left, r["lo"], r["hi"]
                break
            left -= r["n"]
        else:
            raise RuntimeError(f"{s.column} changed between two passes; materialize the input first")
        if s.low == s.high:
            s.value = s.low
