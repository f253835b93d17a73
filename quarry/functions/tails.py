"""Normal and Student-t tail probabilities for already aggregated rows.

Spark has no erf or incomplete beta function, so these run as vectorised
pandas UDFs -- only on the handful of rows that hold test statistics, never
on the raw data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


NODES, WEIGHTS = np.polynomial.legendre.leggauss(32)
PANELS = 64


def _gamma_ratio(z: float) -> float:
    """Gamma(z + 1/2) / Gamma(z); by its asymptotic series where logarithms would cancel."""
    if z < 50:
        return math.exp(math.lgamma(z + 0.5) - math.lgamma(z))
    return math.sqrt(z) * (1 - 1 / (8 * z) + 1 / (128 * z**2) + 5 / (1024 * z**3) - 21 / (32768 * z**4))


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| >= |t|) for Student's t with ``dof`` degrees of freedom (1 or more).

    With x = sqrt(dof) tan(a) the density becomes a power of the cosine,
    2 c cos(a)^(dof - 1); it is integrated from atan(|t| / sqrt(dof)) by
    Gauss-Legendre panels over its whole range, or over 45 of its widths
    where it is narrow. One rule holds for every dof.
    """
    if t is None or dof is None or math.isnan(t) or math.isnan(dof) or dof < 1:
        return float("nan")
    if math.isinf(t):
        return 0.0
    lo = math.atan(abs(t) / math.sqrt(dof))
    hi = min(math.pi / 2, lo + 45 / math.sqrt(dof))
    edges = np.linspace(lo, hi, PANELS + 1)
    half = (edges[1:] - edges[:-1]) / 2
    a = (edges[1:] + edges[:-1])[:, None] / 2 + half[:, None] * NODES
    power = np.exp((dof - 1) / 2 * np.log1p(-np.minimum(np.sin(a) ** 2, 1 - 1e-16)))
    area = float((power * WEIGHTS).sum(1) @ half)
    return min(1.0, 2 * _gamma_ratio(dof / 2) / math.sqrt(math.pi) * area)


def normal_two_sided(z: float) -> float:
    """P(|Z| >= |z|) for a standard normal."""
    if z is None or math.isnan(z):
        return float("nan")
    return math.erfc(abs(z) / math.sqrt(2.0))


@F.pandas_udf(T.DoubleType())
def normal_p_udf(z: pd.Series) -> pd.Series:
    return pd.Series([normal_two_sided(v) for v in z.astype("float64")], dtype="float64")


@F.pandas_udf(T.DoubleType())
def t_p_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    vals = [t_two_sided(a, b) for a, b in zip(t.astype("float64"), dof.astype("float64"))]
    return pd.Series(np.asarray(vals, dtype="float64"))
