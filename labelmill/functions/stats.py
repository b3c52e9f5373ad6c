"""Small statistics, as columns and in numpy."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, functions as F

_LOG_FACTORIALS = np.zeros(1)


def log_factorial(n: np.ndarray) -> np.ndarray:
    """log n!, from a table of running sums that grows as needed."""
    global _LOG_FACTORIALS
    n = np.asarray(n, np.int64)
    most = int(n.max(initial=0))
    if most >= len(_LOG_FACTORIALS):
        _LOG_FACTORIALS = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 2 * most + 16)))])
    return _LOG_FACTORIALS[n]


def binomial_pmf(k, n, p: float) -> np.ndarray:
    """Chance of k hits in n tries, in log space; 0 where k > n."""
    k, n = np.broadcast_arrays(np.asarray(k, np.int64), np.asarray(n, np.int64))
    if p <= 0 or p >= 1:
        return np.where(k == (0 if p <= 0 else n), 1.0, 0.0)
    fits = (k <= n) & (k >= 0)
    kk, nn = np.where(fits, k, 0), np.where(fits, n, 0)
    logs = log_factorial(nn) - log_factorial(kk) - log_factorial(nn - kk) + kk * math.log(p) + (nn - kk) * math.log1p(-p)
    return np.where(fits, np.exp(logs), 0.0)


def binomial_pmf_col(k: Column, n: Column, p: Column) -> Column:
    """The same as a column, for k and n of ordinary size and 0 < p < 1."""
    logs = F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), F.lit(0.0), lambda s, i: s + F.ln((n - k + i) / i))
    return F.when((k > n) | (k < 0), 0.0).otherwise(F.exp(F.when(k > 0, logs).otherwise(0.0) + k * F.ln(p) + (n - k) * F.ln(1 - p)))


def beta_mean(a: Column, b: Column) -> Column:
    return a / (a + b)


def beta_mode(a: Column, b: Column) -> Column:
    """Mode of a Beta distribution; null where it has none."""
    return F.when((a > 1) & (b > 1), (a - 1) / (a + b - 2)).when((a > 1) & (b <= 1), 1.0).when((a <= 1) & (b > 1), 0.0)


def guess_beta(guess: Column, strength: float = 5.0) -> tuple[Column, Column]:
    """Parameters of a Beta distribution around a guess, neither below 0.1."""
    a = F.greatest(guess * strength, F.lit(0.1))
    return a, F.greatest(F.lit(float(strength)) - a, F.lit(0.1))


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))
