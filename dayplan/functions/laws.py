"""Quantile functions of the departure-time laws, truncated to a time window.

A draw u becomes Q(F(lo) + u (F(hi) - F(lo))), which has the law of redrawing until the
value falls into the window, without a loop. Ten laws have a closed form; three (argus,
von Mises, beta) read a table of quantile knots made once from their density.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

KNOTS = 4096

# Rational approximation of the standard normal quantile (P. J. Acklam; fixed values)
ACKLAM_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
            1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
ACKLAM_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
            6.680131188771972e01, -1.328068155288572e01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
            -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
            3.754408661907416e00)
ACKLAM_LOW = 0.02425


def _poly(coefficients: tuple[float, ...], x: Column) -> Column:
    acc = F.lit(coefficients[0])
    for c in coefficients[1:]:
        acc = acc * x + F.lit(c)
    return acc


def normal_quantile(p: Column) -> Column:
    """Standard normal quantile, relative error about 1e-9."""
    low_r = F.sqrt(-2.0 * F.log(p))
    high_r = F.sqrt(-2.0 * F.log(1.0 - p))
    mid, r = p - 0.5, (p - 0.5) * (p - 0.5)

    def tail(q: Column) -> Column:
        return _poly(ACKLAM_C, q) / (_poly(ACKLAM_D, q) * q + 1.0)

    centre = _poly(ACKLAM_A, r) * mid / (_poly(ACKLAM_B, r) * r + 1.0)
    return (
        F.when(p < ACKLAM_LOW, tail(low_r))
        .when(p > 1.0 - ACKLAM_LOW, -tail(high_r))
        .otherwise(centre)
    )


def _phi(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


@dataclass(frozen=True)
class Law:
    """A standard law stretched by ``loc`` and ``scale`` and cut to [low, high)."""

    kind: str
    shape: tuple[float, ...]
    loc: float
    scale: float
    low: float
    high: float

    # ---- closed forms on the standard scale

    def cdf(self, z: float) -> float:
        k, s = self.kind, self.shape
        if k == "bradford":
            return math.log1p(s[0] * min(max(z, 0.0), 1.0)) / math.log1p(s[0])
        if k == "burr":
            return (1.0 + z ** -s[0]) ** -s[1] if z > 0 else 0.0
        if k == "genlogistic":
            return (1.0 + math.exp(-z)) ** -s[0]
        if k == "johnsonsb":
            if z <= 0 or z >= 1:
                return 0.0 if z <= 0 else 1.0
            return _phi(s[0] + s[1] * math.log(z / (1.0 - z)))
        if k == "pareto":
            return 1.0 - z ** -s[0] if z > 1 else 0.0
        if k == "weibull_min":
            return -math.expm1(-(z ** s[0])) if z > 0 else 0.0
        if k == "levy":
            return math.erfc(math.sqrt(0.5 / z)) if z > 0 else 0.0
        if k == "triang":
            if z <= 0 or z >= 1:
                return 0.0 if z <= 0 else 1.0
            c = s[0]
            return z * z / c if z < c else 1.0 - (1.0 - z) ** 2 / (1.0 - c)
        if k == "exponweib":
            return (-math.expm1(-(z ** s[1]))) ** s[0] if z > 0 else 0.0
        raise ValueError(f"no closed form for {k}")

    def _standard_quantile(self, q: Column) -> Column:
        k, s = self.kind, self.shape
        if k == "bradford":
            return (F.pow(F.lit(1.0 + s[0]), q) - 1.0) / s[0]
        if k == "burr":
            return F.pow(F.pow(q, F.lit(-1.0 / s[1])) - 1.0, F.lit(-1.0 / s[0]))
        if k == "genlogistic":
            return -F.log(F.pow(q, F.lit(-1.0 / s[0])) - 1.0)
        if k == "johnsonsb":
            return 1.0 / (1.0 + F.exp(-(normal_quantile(q) - s[0]) / s[1]))
        if k == "pareto":
            return F.pow(1.0 - q, F.lit(-1.0 / s[0]))
        if k == "weibull_min":
            return F.pow(-F.log1p(-q), F.lit(1.0 / s[0]))
        if k == "levy":
            root = normal_quantile(q / 2.0)
            return 1.0 / (root * root)
        if k == "triang":
            c = s[0]
            return F.when(q < c, F.sqrt(c * q)).otherwise(1.0 - F.sqrt((1.0 - c) * (1.0 - q)))
        if k == "exponweib":
            return F.pow(-F.log1p(-F.pow(q, F.lit(1.0 / s[0]))), F.lit(1.0 / s[1]))
        raise ValueError(f"no closed form for {k}")

    # ---- tabulated laws

    @property
    def tabulated(self) -> bool:
        return self.kind in ("argus", "vonmises", "beta")

    def density(self, z: np.ndarray) -> np.ndarray:
        """Density up to a factor, on its support."""
        s = self.shape
        if self.kind == "argus":
            inner = np.clip(1.0 - z * z, 0.0, None)
            return z * np.sqrt(inner) * np.exp(-0.5 * s[0] * s[0] * inner)
        if self.kind == "vonmises":
            return np.exp(s[0] * np.cos(z))
        return np.power(z, s[0] - 1.0) * np.power(1.0 - z, s[1] - 1.0)

    @cached_property
    def _support(self) -> tuple[float, float]:
        left, right = (-math.pi, math.pi) if self.kind == "vonmises" else (0.0, 1.0)
        return (
            max(left, (self.low - self.loc) / self.scale),
            min(right, (self.high - self.loc) / self.scale),
        )

    @cached_property
    def knots(self) -> list[float]:
        """Times at the truncated quantiles 0, 1/4096, ..., 1."""
        a, b = self._support
        edges = np.linspace(a, b, 200_001)
        middle = (edges[:-1] + edges[1:]) / 2.0
        mass = np.concatenate([[0.0], np.cumsum(self.density(middle))])
        at = np.interp(np.linspace(0.0, 1.0, KNOTS + 1), mass / mass[-1], edges)
        # twelve digits, so that every engine reads the same numbers
        return [float(f"{self.loc + self.scale * z:.12g}") for z in at]

    # ---- public

    @cached_property
    def mass(self) -> tuple[float, float]:
        """F(low), F(high) on the standard scale."""
        return (
            self.cdf((self.low - self.loc) / self.scale),
            self.cdf((self.high - self.loc) / self.scale),
        )

    def quantile(self, u: Column) -> Column:
        """Time of day for a uniform draw in (0, 1)."""
        if self.tabulated:
            return between_knots(self.knots, u)
        f_low, f_high = self.mass
        q = F.lit(f_low) + u * F.lit(f_high - f_low)
        return F.lit(self.loc) + F.lit(self.scale) * self._standard_quantile(q)

    def quantile_before(self, u: Column, end: Column) -> Column:
        """Time of day for a uniform draw in (0, 1), given that it is before ``end``."""
        if self.kind != "weibull_min":
            raise ValueError(f"no distribution function as a column for {self.kind}")
        z = F.greatest((end - self.loc) / self.scale, F.lit(0.0))
        low = F.lit(self.mass[0])
        q = low + u * (-F.expm1(-F.pow(z, F.lit(self.shape[0]))) - low)
        return F.lit(self.loc) + F.lit(self.scale) * self._standard_quantile(q)


def between_knots(knots: list[float], u: Column) -> Column:
    """Value at quantile ``u`` in (0, 1) of a table of KNOTS + 1 equal steps."""
    text = ",".join(repr(v) for v in knots)
    table = F.split(F.lit(text), ",").cast("array<double>")  # folded to one literal
    at = u * float(KNOTS)
    i = F.floor(at).cast("int")
    left, right = F.element_at(table, i + 1), F.element_at(table, i + 2)
    return left + (right - left) * (at - i)


def later_knots(first: Law, second: Law) -> list[float]:
    """Quantile knots of ``second`` given that an independent draw of ``first`` is earlier.

    Both have closed distribution functions. The density is that of ``second`` times the
    chance that ``first`` came before.
    """
    edges = np.linspace(second.low, second.high, 20_001)
    middle = (edges[:-1] + edges[1:]) / 2.0
    whole = np.array([second.cdf((t - second.loc) / second.scale) for t in edges])
    low, high = first.mass
    before = np.array([(first.cdf((t - first.loc) / first.scale) - low) / (high - low) for t in middle])
    mass = np.concatenate([[0.0], np.cumsum(np.diff(whole) * np.clip(before, 0.0, 1.0))])
    at = np.interp(np.linspace(0.0, 1.0, KNOTS + 1), mass / mass[-1], edges)
    return [float(f"{t:.12g}") for t in at]
