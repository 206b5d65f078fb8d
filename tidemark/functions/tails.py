"""Tail probabilities on one-row or one-row-per-test results. Small numeric helpers, numpy only."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

_NORMAL = NormalDist()


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def gamma_upper(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function: series below s + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1:
        term = total = 1 / s
        n = s
        while term > total * 1e-17:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - front * total)
    b, c, d = x + 1 - s, 1e300, 1 / (x + 1 - s)
    total, n = d, 0
    while True:
        n += 1
        b += 2
        d = 1 / (b - n * (n - s) * d)
        c = b - n * (n - s) / c
        total *= c * d
        if abs(c * d - 1) < 1e-16 * 8:
            return front * total


#: Degrees of freedom from which the beta function is taken from its gamma limit, then correct to 1e-12.
_LARGE = 1e6


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz).

    With one very large parameter the logarithms of gamma functions cancel each other, and the
    gamma function of the other parameter takes over, the argument corrected to second order.
    """
    if a > _LARGE > b and 0 < x < 1:
        return gamma_upper(b, -(a + (b - 1) / 2) * math.log(x))
    if b > _LARGE > a and 0 < x < 1:
        return 1 - gamma_upper(a, -(b + (a - 1) / 2) * math.log1p(-x))
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - betainc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    d = 1 / (1 - (a + b) * x / (a + 1) or tiny)
    c, total = 1.0, d
    for m in range(1, 100000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + step * d) or tiny)
            c = (1 + step / c) or tiny
            total *= c * d
        if abs(c * d - 1) < 1e-15:
            return min(1.0, front * total)
    raise ArithmeticError(f"no value of the incomplete beta function for {a}, {b}, {x}")


def t_two_sided(t: float, df: float) -> float:
    if df / 2 > _LARGE:  # the argument is too near to 1 for its logarithm
        return gamma_upper(0.5, (df / 2 - 0.25) * math.log1p(t * t / df))
    return betainc(df / 2, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f > 0 and d2 / 2 > _LARGE > d1 / 2:
        return gamma_upper(d1 / 2, (d2 / 2 + (d1 / 2 - 1) / 2) * math.log1p(d1 * f / d2))
    return betainc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


# Tables that a worker computes once: the normal distribution function, scale nodes, quantiles.
_KEPT: dict = {}


def _once(key, compute):
    if key not in _KEPT:
        _KEPT[key] = compute()
    return _KEPT[key]


def _normal_grid() -> tuple[np.ndarray, np.ndarray]:
    z = np.linspace(-9, 9, 180001)
    return z, np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])


def _cdf(z: np.ndarray) -> np.ndarray:
    grid, values = _once("normal", _normal_grid)
    return np.interp(z, grid, values)


def _scale_nodes(df: float) -> tuple[np.ndarray, np.ndarray]:
    """Quadrature of the density of s = sqrt(chi2_df / df)."""
    half = 8 / math.sqrt(2 * df)
    low, high = max(0.0, 1 - half), 1 + half + (4 / df)
    x, w = np.polynomial.legendre.leggauss(40)
    s = (high - low) / 2 * x + (high + low) / 2
    log_f = (
        math.log(2) + (df / 2) * math.log(df / 2) - math.lgamma(df / 2) + (df - 1) * np.log(np.maximum(s, 1e-300)) - df * s * s / 2
    )
    f = np.exp(log_f) * w * (high - low) / 2
    return s, f / f.sum()


def studentized_range_sf(q: float, k: int, df: float) -> float:
    """P(range of k standard normals > q * s), integrated over the range and the scale."""
    if q <= 0:
        return 1.0
    x, w = np.polynomial.legendre.leggauss(112)
    z, wz = 8.5 * x, 8.5 * w
    dens = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * wz
    s, ws = _once(("scale", float(df)), lambda: _scale_nodes(float(df)))
    inner = np.maximum(_cdf(z)[None, :] - _cdf(z[None, :] - q * s[:, None]), 0.0)
    below = k * (inner ** (k - 1) * dens[None, :]).sum(axis=1)
    return float(min(1.0, max(0.0, 1 - (below * ws).sum())))


def studentized_range_quantile(alpha: float, k: int, df: float) -> float:
    def search() -> float:
        low, high = 0.0, 200.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if studentized_range_sf(mid, k, df) > alpha else (low, mid)
        return (low + high) / 2

    return _once(("quantile", alpha, k, float(df)), search)


#: Nodes of a tail's table over u = q / (q + 4), evenly spaced.
NODES = 1200


def studentized_range_table(k: int, df: float) -> list[float]:
    """studentized_range_sf at q = 4 u / (1 - u) for NODES + 1 values of u from 0 to 1."""
    u = np.arange(NODES) / NODES
    return _once(("table", k, float(df)), lambda: [*(studentized_range_sf(4 * x / (1 - x), k, df) for x in u), 0.0])


def tabulated_tail(q: Column, table: list[float]) -> Column:
    """The tail at any q, by the polynomial through the six nodes around it; it agrees with the integral to 1e-8."""
    at = q / (q + 4) * NODES
    first = F.greatest(F.lit(0), F.least(F.lit(NODES - 5), F.floor(at).cast("int") - 2))
    t, values = at - first, F.array(*map(F.lit, table))
    total = F.lit(0.0)
    for j in range(6):
        weight = F.lit(1.0)
        for m in range(6):
            if m != j:
                weight = weight * (t - m) / (j - m)
        total = total + weight * F.element_at(values, first + j + 1)
    return F.when(q <= 0, 1.0).when(q == float("inf"), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def mann_whitney_exact(u: float, n1: int, n2: int) -> float:
    """Two-sided exact p of U without ties, from the numbers of subsets for the smaller tail.

    The distribution is symmetric, so that only the counts up to the smaller of U and n1*n2 - U are
    built, from small to large: no tail is a difference of large sums. The smaller sample has at
    most 8 values, and the counts take 16 bytes for each value of U in the tail.
    """
    n1, n2 = sorted((int(n1), int(n2)))
    last = int(math.floor(min(u, n1 * n2 - u)))
    if last < 0:
        return 0.0
    ways = np.zeros(last + 1, dtype=np.longdouble)
    ways[0] = 1
    # Gaussian binomial: multiply by (1 - x^(n2+i)), divide by (1 - x^i)
    for i in range(1, n1 + 1):
        if n2 + i <= last:
            ways[n2 + i :] -= ways[: last + 1 - n2 - i].copy()
        for r in range(min(i, last + 1)):
            ways[r::i] = np.cumsum(ways[r::i])
    tail = float(np.maximum(ways, 0).sum() / np.longdouble(math.comb(n1 + n2, n1)))
    return min(1.0, 2 * tail)


def mann_whitney_p(u: float, n1: float, n2: float, ties: float) -> float:
    """Two-sided p of U: exact if a sample has at most 8 values and there are no ties, else normal.

    The normal form corrects the variance for ties and the distance for continuity.
    """
    if min(n1, n2) <= 8 and ties == 0:
        return mann_whitney_exact(u, int(n1), int(n2))
    n = n1 + n2
    sd = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
    if sd == 0:
        return 1.0
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sd
    return min(1.0, 2 * normal_sf(z))


def normal_scores(p: pd.Series) -> pd.Series:
    """Normal quantiles, null for null."""
    return pd.Series([None if pd.isna(v) else _NORMAL.inv_cdf(v) for v in p], dtype="float64")


def shapiro_w(
    n: float, mm: float, mx: float, m_last: float, m_next: float, x1: float, x2: float, x_next: float, x_last: float, ss: float
) -> float:
    """W from sums over the sorted sample, by Royston's 1995 weights, for 3 to 5000 values.

    mm and mx are the sums of squared normal scores and of score times value, m_last and m_next
    the two largest scores, x1, x2, x_next, x_last the outer values and ss the sum of squares.
    """
    if x1 == x_last:
        return 1.0
    if n == 3:
        return min(1.0, (x_last - x1) ** 2 / 2 / ss)
    u = 1 / math.sqrt(n)
    # Published polynomial coefficients, constant term last.
    last = float(np.polyval([-2.706056, 4.434685, -2.07119, -0.147981, 0.221157, m_last / math.sqrt(mm)], u))
    outer = last * (x_last - x1)
    inner = mx - m_last * (x_last - x1)
    if n > 5:
        second = float(np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, m_next / math.sqrt(mm)], u))
        phi = (mm - 2 * m_last**2 - 2 * m_next**2) / (1 - 2 * last**2 - 2 * second**2)
        outer += second * (x_next - x2)
        inner -= m_next * (x_next - x2)
    else:
        phi = (mm - 2 * m_last**2) / (1 - 2 * last**2)
    return min(1.0, (outer + inner / math.sqrt(phi)) ** 2 / ss)


def shapiro_p(w: float, n: float) -> float:
    """p of W by Royston's 1995 approximation."""
    if w >= 1:
        return 1.0
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    y, log_n = math.log1p(-w), math.log(n)
    # Published mean and log deviation of the normalised statistic.
    if n <= 11:
        gamma = 0.459 * n - 2.273
        if y >= gamma:
            return 0.0
        y = -math.log(gamma - y)
        mu = np.polyval([-0.0006714, 0.025054, -0.39978, 0.544], n)
        sd = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        mu = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], log_n)
        sd = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], log_n))
    return normal_sf((y - mu) / sd)


def tail_udf(fn, *args: Column) -> Column:
    """Apply a tail function to a result table of a few rows; null in, null out."""

    def run(rows: pd.DataFrame) -> pd.Series:
        known = rows.notna().all(axis=1)
        values = [fn(*row) if ok else None for row, ok in zip(rows.itertuples(index=False), known)]
        return pd.Series(values, dtype="float64")

    packed = F.struct(*[a.cast("double").alias(f"a{i}") for i, a in enumerate(args)])
    return F.pandas_udf(run, "double")(packed)
