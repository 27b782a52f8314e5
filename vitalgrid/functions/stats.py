"""Small numeric helpers that Spark has no built-in for; all are vectorised over Arrow batches."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the regularised incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    guard = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c = np.ones_like(x)
    d = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    h = d.copy()
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / guard(1.0 + num * d)
            c = guard(1.0 + num / c)
            h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return h


def incomplete_beta(a, b, x) -> np.ndarray:
    a, b, x = (np.atleast_1d(np.asarray(v, dtype=float)) for v in (a, b, x))
    a, b, x = np.broadcast_arrays(a, b, x)
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    inner = np.clip(x, 1e-300, 1 - 1e-16)
    front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(inner) + b * np.log1p(-inner))
    direct = x < (a + 1.0) / (a + b + 2.0)
    left = front * _beta_fraction(a, b, np.where(direct, inner, 0.0)) / a
    right = 1.0 - front * _beta_fraction(b, a, np.where(direct, 0.0, 1.0 - inner)) / b
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, np.where(direct, left, right)))


def slope_p_value(r, n) -> np.ndarray:
    """Two-sided p-value of a regression slope from the correlation and the number of points."""
    r, n = np.asarray(r, dtype=float), np.asarray(n, dtype=float)
    dof = np.maximum(n - 2, 1.0)
    t2 = r * r * dof / ((1.0 - r + 1e-20) * (1.0 + r + 1e-20))
    p = incomplete_beta(dof / 2.0, 0.5, dof / (dof + t2))
    return np.where(n > 2, p, np.where(np.abs(r) > 0, 0.0, 1.0))


@F.pandas_udf(DoubleType())
def slope_p_value_of(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(np.where(r.isna(), np.nan, slope_p_value(r.fillna(0.0), n))).where(r.notna().to_numpy(), None)


COMPARISONS = 4_000_000  # held in memory at a time


def approximate_entropy(rows: np.ndarray, m: int = 2, r: float = 0.2) -> np.ndarray:
    """Approximate entropy of each row of a (windows × points) matrix; tolerance r·std."""
    points = rows.shape[1]
    if points <= m + 1:
        return np.zeros(len(rows))
    tolerance = (r * rows.std(axis=1))[:, None, None]

    def phi(length: int) -> np.ndarray:
        places = points - length + 1
        share = np.empty((len(rows), places))
        step = max(1, COMPARISONS // (len(rows) * places))
        for begin in range(0, places, step):
            end = min(begin + step, places)
            near = np.ones((len(rows), end - begin, places), dtype=bool)
            for d in range(length):
                near &= np.abs(rows[:, begin + d : end + d, None] - rows[:, None, d : d + places]) <= tolerance
            share[:, begin:end] = near.mean(axis=2)
        return np.log(share).mean(axis=1)

    return np.abs(phi(m) - phi(m + 1))


@F.pandas_udf(DoubleType())
def approximate_entropy_of(windows: pd.Series) -> pd.Series:
    """Column form: one array of values, in order, per row. Windows of equal length are computed
    together, as many as fit the comparison limit."""
    result = np.full(len(windows), np.nan)
    lengths = windows.map(lambda w: -1 if w is None else len(w)).to_numpy()
    for size in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == size)
        for part in np.array_split(at, len(at) * int(size) ** 2 // COMPARISONS + 1):
            result[part] = approximate_entropy(np.stack(windows.iloc[part].to_list()).astype(float))
    return pd.Series(result)
