"""Null, infinity and division rules shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def flag(condition: Column) -> Column:
    """0/1 dummy; an unknown comparison counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """n/d where x/0 is a signed infinity and 0/0 is null."""
    n, d = numerator.cast("double"), denominator.cast("double")
    by_zero = F.when(n > 0, F.lit(INF)).when(n < 0, F.lit(-INF))
    return F.when(d == 0, by_zero).otherwise(n / d)


def finite(value: Column) -> Column:
    """Infinities and NaN become null."""
    v = value.cast("double")
    return F.when(~F.isnan(v) & (v != INF) & (v != -INF), v)


def clamp(value: Column, low: float, high: float) -> Column:
    """Winsorise to [low, high]; null stays null."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def zero_fill(text: Column, width: int) -> Column:
    """Left-pad with zeros without ever cutting longer text."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def recode(value: Column, codes: dict) -> Column:
    """Map codes by a fixed table; an unmapped value is null."""
    groups: dict = {}
    for source, target in codes.items():
        groups.setdefault(target, []).append(source)
    out = None
    for target, sources in groups.items():
        test = value.isin(sources)
        out = F.when(test, F.lit(target)) if out is None else out.when(test, F.lit(target))
    return out


def wrap_day(hours: Column) -> Column:
    """Times past midnight move to the start of the day; exactly 24 stays."""
    return F.when(hours > 24, hours - 24).otherwise(hours)
