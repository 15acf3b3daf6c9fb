"""Distribution tails of single statistics, evaluated on the driver.

Spark ships commons-math3; only finished scalars are passed to it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import SparkSession


def _math(spark: SparkSession):
    return spark._jvm.org.apache.commons.math3


def f_tail(spark: SparkSession, f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    if not f > 0:
        return 1.0
    return _math(spark).special.Beta.regularizedBeta(d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0)


def t_tail(spark: SparkSession, t: float, df: float) -> float:
    """P(|T| > |t|)."""
    return _math(spark).special.Beta.regularizedBeta(df / (df + t * t), df / 2.0, 0.5)


def t_quantile(spark: SparkSession, p: float, df: float) -> float:
    return _math(spark).distribution.TDistribution(float(df)).inverseCumulativeProbability(p)


def chi2_tail(spark: SparkSession, x: float, df: float) -> float:
    return _math(spark).special.Gamma.regularizedGammaQ(df / 2.0, x / 2.0) if x > 0 else 1.0


def _range_cdf(q: np.ndarray, groups: int) -> np.ndarray:
    """CDF of the range of ``groups`` standard normals, by Gauss-Legendre quadrature."""
    nodes, weights = np.polynomial.legendre.leggauss(120)
    z = 9.0 * nodes
    phi = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    erf = np.frompyfunc(math.erf, 1, 1)

    def cdf(x):
        return 0.5 * (1 + erf(np.asarray(x) / math.sqrt(2)).astype(float))

    inner = cdf(z)[None, :] - cdf(z[None, :] - np.asarray(q)[:, None])
    return groups * (9.0 * weights * phi * np.maximum(inner, 0.0) ** (groups - 1)).sum(axis=1)


def _stirling_rest(x: float) -> float:
    """log Gamma(x) without (x - 1/2) log x - x + log(2 pi) / 2; by its series where the difference would lose digits."""
    if x < 100:
        return math.lgamma(x) - ((x - 0.5) * math.log(x) - x + 0.5 * math.log(2 * math.pi))
    return 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def studentized_range_tail(q: float, groups: int, df: float) -> float:
    """P(Q > q) of the studentized range, integrating over the pooled sd; for any degrees of freedom."""
    nodes, weights = np.polynomial.legendre.leggauss(80)
    spread = 8.0 / math.sqrt(2 * df)
    lo, hi = max(1e-9, 1 - spread), 1 + spread
    off = lo - 1 + (nodes + 1) * (hi - lo) / 2  # sd minus 1
    half = df / 2
    log_pdf = (
        math.log(2) + 0.5 * math.log(half) - 0.5 * math.log(2 * math.pi) - _stirling_rest(half)
        + half * (2 * np.log1p(off) - 2 * off - off * off) - np.log1p(off)
    )
    body = np.exp(log_pdf) * _range_cdf(q * (1 + off), groups)
    return float(min(1.0, max(0.0, 1 - (weights * body).sum() * (hi - lo) / 2)))


def studentized_range_quantile(p: float, groups: int, df: float) -> float:
    lo, hi = 0.0, 100.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 1 - studentized_range_tail(mid, groups, df) < p else (lo, mid)
    return (lo + hi) / 2
