"""Conditional logit estimation by Newton's method.

The choice table is packed once to one row per chooser and stored. A pass is a narrow
job over those rows: each task returns its summed log-likelihood, gradient and Hessian,
which Spark adds up, so only 1 + p + p^2 numbers reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayplan.session import materialize


@dataclass(frozen=True)
class FitResult:
    """Without usable choosers (n = 0) nothing is known but the names: every figure is None."""

    names: list[str]
    coef: list[float | None]
    cov: list[list[float | None]]
    n: int
    ll: float | None
    ll_null: float | None

    @property
    def k(self) -> int:
        return len(self.coef)

    @property
    def r2(self) -> float | None:
        return 1.0 - self.ll / self.ll_null if self.n else None

    @property
    def r2_bar(self) -> float | None:
        return 1.0 - (self.ll - self.k) / self.ll_null if self.n else None

    @property
    def aic(self) -> float | None:
        return 2.0 * self.k - 2.0 * self.ll if self.n else None

    @property
    def bic(self) -> float | None:
        return self.k * math.log(self.n) - 2.0 * self.ll if self.n else None

    def table(self) -> list[dict]:
        """Coefficient, standard error, z and two-sided p of each term."""
        out = []
        for i, name in enumerate(self.names):
            if not self.n:
                out.append({"term": name, "coef": None, "std_err": None, "z": None, "p": None})
                continue
            se = math.sqrt(self.cov[i][i])
            z = self.coef[i] / se
            p = math.erfc(abs(z) / math.sqrt(2.0))
            out.append({"term": name, "coef": self.coef[i], "std_err": se, "z": z, "p": p})
        return out

    def summary(self) -> dict[str, float | None]:
        return {
            "n": self.n, "k": self.k, "df_resid": self.n - self.k, "ll": self.ll,
            "ll_null": self.ll_null, "r2": self.r2, "r2_bar": self.r2_bar,
            "aic": self.aic, "bic": self.bic,
        }


def pack_choices(table: DataFrame, chooser: str, chosen: str, terms: list[list[str]]) -> DataFrame:
    """One row per chooser: the chosen position and the flat attribute matrix.

    A chooser's list holds its few sampled alternatives. Choosers with an unknown
    attribute or without exactly one chosen alternative are left out.
    """
    features = []
    for factors in terms:
        product = F.expr(factors[0]).cast("double")
        for f in factors[1:]:
            product = product * F.expr(f).cast("double")
        features.append(product)
    row = F.struct(
        (F.lit(1) - F.col(chosen)).alias("rest"), F.array(*features).alias("x")
    )  # the chosen row sorts first
    total = features[0]
    for f in features[1:]:
        total = total + f
    return (
        table.select(F.col(chooser).alias("chooser"), F.col(chosen), row.alias("r"), total.alias("t"))
        .groupBy("chooser")
        .agg(
            F.sort_array(F.collect_list("r")).alias("rows"),
            F.sum(chosen).alias("hits"),
            F.count(F.when(F.col("t").isNull(), 1)).alias("bad"),
        )
        .where("hits = 1 and bad = 0")
        .select(F.size("rows").alias("j"), F.flatten(F.col("rows.x")).alias("x"))
    )


def _partials(beta: np.ndarray):
    p = len(beta)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros(1 + p + p * p)
        for batch in batches:
            for j, part in batch.groupby("j"):
                x = np.concatenate(part["x"].to_numpy()).reshape(len(part), int(j), p)
                v = x @ beta
                v -= v.max(axis=1, keepdims=True)
                e = np.exp(v)
                prob = e / e.sum(axis=1, keepdims=True)
                mean = np.einsum("nj,njp->np", prob, x)
                acc[0] += float((v[:, 0] - np.log(e.sum(axis=1))).sum())
                acc[1 : 1 + p] += (x[:, 0, :] - mean).sum(axis=0)
                weighted = (prob[:, :, None] * x).reshape(-1, p)
                acc[1 + p :] -= (weighted.T @ x.reshape(-1, p) - mean.T @ mean).ravel()
        yield pd.DataFrame({"part": [acc.tolist()]})

    return run


def _evaluate(packed: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    p = len(beta)
    parts = packed.mapInPandas(_partials(beta), "part array<double>")
    rows = (
        parts.select(F.posexplode("part").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
        .collect()  # 1 + p + p^2 rows
    )
    flat = np.zeros(1 + p + p * p)
    for r in rows:
        flat[r["i"]] = r["v"]
    return float(flat[0]), flat[1 : 1 + p], flat[1 + p :].reshape(p, p)


def fit_conditional_logit(
    table: DataFrame,
    chooser: str,
    chosen: str,
    terms: list[list[str]],
    names: list[str] | None = None,
    tolerance: float = 1e-8,
    max_iterations: int = 50,
) -> FitResult:
    """Maximum-likelihood coefficients of a long choice table with a 0/1 ``chosen`` column.

    A chooser with an unknown attribute is left out; if none is left, the coefficients are unknown (None).
    Raises if ``max_iterations`` Newton steps do not reach ``tolerance`` or no step gains.
    """
    packed = materialize(pack_choices(table, chooser, chosen, terms), "fit")
    sizes = packed.groupBy("j").agg(F.count("*").alias("n")).collect()  # a row per set size
    n = sum(r["n"] for r in sizes)
    labels = names or [":".join(t) for t in terms]
    if n == 0:
        unknown = [None] * len(terms)
        return FitResult(labels, unknown, [unknown] * len(terms), 0, None, None)
    ll_null = -sum(r["n"] * math.log(r["j"]) for r in sizes)
    beta = np.zeros(len(terms))
    ll, gradient, hessian = _evaluate(packed, beta)
    for _ in range(max_iterations):
        step = np.linalg.solve(-hessian, gradient)
        if float(gradient @ step) < tolerance:
            break
        scale = 1.0
        while True:
            trial = _evaluate(packed, beta + scale * step)
            if trial[0] >= ll - 1e-12 * abs(ll):
                break
            scale /= 2.0
            if scale < 1e-6:
                raise RuntimeError("no step along the Newton direction gains")
        beta = beta + scale * step
        ll, gradient, hessian = trial
    else:
        raise RuntimeError(f"not converged after {max_iterations} steps")
    cov = np.linalg.inv(-hessian)
    return FitResult(labels, beta.tolist(), cov.tolist(), n, ll, ll_null)
