"""Normal and Student-t probabilities for already aggregated rows (one row per comparison).

Spark has no error function or incomplete beta function; these are the only Python functions
of the package that run inside a query, and they see a handful of rows.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LARGE_DF = 1e6  # beyond it the normal approximation of t is exact to about 1e-12


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def normal_two_sided(z: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(abs(v) / math.sqrt(2.0)) for v in np.atleast_1d(z)])


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, modified Lentz method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 5000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b


def _t_two_sided(t: float, df: float) -> float:
    if math.isnan(t) or math.isnan(df):
        return math.nan
    if df > LARGE_DF:
        z = t * (1.0 - 1.0 / (4.0 * df)) / math.sqrt(1.0 + t * t / (2.0 * df))
        return math.erfc(abs(z) / math.sqrt(2.0))
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def t_two_sided(t, df) -> np.ndarray:
    return np.array([_t_two_sided(a, b) for a, b in zip(np.atleast_1d(t), np.atleast_1d(df))])


def _t_critical(alpha: float, df: float) -> float:
    """The t with two-sided probability ``alpha``, by bisection."""
    if math.isnan(df) or math.isnan(alpha):
        return math.nan
    low, high = 0.0, 2.0
    while _t_two_sided(high, df) > alpha:
        high *= 2.0
    for _ in range(100):
        mid = (low + high) / 2.0
        low, high = (mid, high) if _t_two_sided(mid, df) > alpha else (low, mid)
    return (low + high) / 2.0


def t_critical(alpha, df) -> np.ndarray:
    return np.array([_t_critical(a, b) for a, b in zip(np.atleast_1d(alpha), np.atleast_1d(df))])


# Missing input arrives as NaN and leaves as NULL.


def _null_if_nan(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def normal_p(z: Column) -> Column:
    """Two-sided normal probability of |z| or more."""

    @F.pandas_udf("double")
    def p(z: pd.Series) -> pd.Series:
        return pd.Series(normal_two_sided(z.to_numpy(dtype=float)))

    return _null_if_nan(p(z))


def t_p(t: Column, df: Column) -> Column:
    """Two-sided Student-t probability of |t| or more."""

    @F.pandas_udf("double")
    def p(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series(t_two_sided(t.to_numpy(dtype=float), df.to_numpy(dtype=float)))

    return _null_if_nan(p(t, df))


def t_crit(alpha: Column, df: Column) -> Column:
    """Critical value of the two-sided t test."""

    @F.pandas_udf("double")
    def critical(alpha: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series(t_critical(alpha.to_numpy(dtype=float), df.to_numpy(dtype=float)))

    return _null_if_nan(critical(alpha, df))
