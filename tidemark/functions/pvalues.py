"""Tail probabilities for the drift tests.

The statistics are aggregates with one row per feature, so the special
functions run as vectorised pandas UDFs over that small result (no scipy in
this environment). Chi-square and F tails are integrals of the density of the
variable's logarithm, which is log-concave: from the statistic the density only
falls towards its tail, so the range in which it matters is found by doubling and
integrated by Gauss-Legendre panels, for any degrees of freedom and without a
limit on iterations. The Kolmogorov limit law is a plain SQL expression; the laws
at finite n are sums and products of positive terms in numpy."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The UDFs below (and the special functions they call) travel to the Python
# workers by value, so executors need no copy of this package for them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_DROP = 60.0  # the tail ends where the density is e**-60 of that at the statistic
_PANELS = 48


def _stirling_rest(a: float) -> float:
    """lgamma(a) less Stirling's main terms (a - 1/2) ln a - a + ln(2 pi) / 2."""
    if a < 12.0:
        return math.lgamma(a) - ((a - 0.5) * math.log(a) - a + 0.5 * math.log(2 * math.pi))
    w = 1.0 / (a * a)
    return (1 / 12 - w * (1 / 360 - w * (1 / 1260 - w / 1680))) / a


def _exp_rest(r: np.ndarray) -> np.ndarray:
    """exp(r) - 1 - r without cancellation near 0."""
    near = r * r / 2 * (1 + r / 3 * (1 + r / 4 * (1 + r / 5 * (1 + r / 6 * (1 + r / 7 * (1 + r / 8))))))
    return np.where(np.abs(r) < 0.05, near, np.expm1(r) - r)


def _tail(log_density: Callable[[np.ndarray], np.ndarray], start: float, sign: int) -> float:
    """Integral of a density from ``start`` towards +inf (sign 1) or -inf (sign -1), where it only falls."""
    top = float(log_density(np.array([start]))[0])
    width = 1e-8
    while float(log_density(np.array([start + sign * width]))[0]) > top - _DROP:
        width *= 2.0
    nodes, weights = np.polynomial.legendre.leggauss(16)
    edges = np.linspace(0.0, width, _PANELS + 1)
    half = np.diff(edges) / 2
    at = start + sign * ((edges[:-1] + half)[:, None] + half[:, None] * nodes)
    return float((np.exp(log_density(at.ravel())).reshape(at.shape) * weights * half[:, None]).sum())


def chi2_sf(stat: float, dof: float) -> float:
    """P(X >= stat) for X ~ chi-square(dof)."""
    if stat is None or dof is None or math.isnan(stat) or math.isnan(dof) or dof <= 0:
        return float("nan")
    if stat <= 0:
        return 1.0
    a = dof / 2.0
    const = 0.5 * math.log(a / (2 * math.pi)) - _stirling_rest(a)

    def log_density(r):  # of r = ln(t / a) for t ~ gamma(a)
        return const - a * _exp_rest(r)

    start = math.log(stat / dof)
    if start >= 0:
        return min(1.0, _tail(log_density, start, 1))
    return max(0.0, 1.0 - _tail(log_density, start, -1))


def f_sf(stat: float, d1: float, d2: float) -> float:
    """P(X >= stat) for X ~ F(d1, d2)."""
    if stat is None or d1 is None or d2 is None or any(math.isnan(v) for v in (stat, d1, d2)):
        return float("nan")
    if d1 <= 0 or d2 <= 0:
        return float("nan")
    if stat <= 0:
        return 1.0
    a, b = d1 / 2.0, d2 / 2.0
    share = a / (a + b)
    # Stirling's main terms of the beta function cancel against the density at its mode u = 0
    const = (0.5 * (math.log(a) + math.log(b) - math.log(a + b) - math.log(2 * math.pi))
             + _stirling_rest(a + b) - _stirling_rest(a) - _stirling_rest(b))

    def log_density(u):  # of u = ln x for x ~ F: a u - (a + b) ln(1 + share (e**u - 1))
        grown = share * np.expm1(np.minimum(u, 700.0))
        big = np.where(u > 700.0, u + math.log(share), np.log1p(grown))
        # small u: both terms nearly cancel, so the rest of each is taken
        e2 = _exp_rest(u)
        small = share * e2 * (a + b) - (a + b) * (grown - np.log1p(grown))
        return const + np.where(np.abs(u) < 0.05, -small, a * u - (a + b) * big)

    start = math.log(stat)
    if start >= 0:
        return min(1.0, _tail(log_density, start, 1))
    return max(0.0, 1.0 - _tail(log_density, start, -1))


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(s), float(d)) if pd.notna(s) and pd.notna(d) else None
                      for s, d in zip(stat, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def f_sf_udf(stat: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_sf(float(s), float(a), float(b)) if pd.notna(s) and pd.notna(a) and pd.notna(b) else None
                      for s, a, b in zip(stat, d1, d2)], dtype="float64")


def one_sided_sf(d: float, n: int) -> float:
    """P(D+ >= d) of the one-sample statistic of n values.

    To SUM_TERMS values the finite sum of positive terms, in logarithms; beyond, its
    expansion in 1 / n, whose relative error is of the order 1 / n."""
    if d <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    if n > SUM_TERMS:
        z = (6.0 * n * d + 1.0) ** 2 / (18.0 * n)
        return math.exp(-z)
    j = np.arange(0, math.floor(n * (1 - d)) + 1)
    j = j[d + j / n < 1]
    steps = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    log = (steps[n] - steps[j] - steps[n - j] + (j - 1) * np.log(d + j / n) + (n - j) * np.log1p(-(d + j / n)) + math.log(d))
    return min(1.0, float(np.exp(log).sum()))


def _inside_matrix(d: float, n: int) -> float:
    """P(D < d) of n values, by the n-th power of the band matrix of one value's step."""
    k = math.floor(n * d) + 1
    h, m = k - n * d, 2 * k - 1
    row = np.arange(m)
    step = (row[:, None] - row[None, :] + 1 >= 0).astype(float)
    step[:, 0] -= h ** np.arange(1, m + 1)
    step[-1, :] -= h ** np.arange(m, 0, -1)
    step[-1, 0] += max(0.0, 2 * h - 1) ** m
    size = row[:, None] - row[None, :] + 1
    factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, m + 1)))])
    step = np.where(size > 0, step * np.exp(-factorial[np.maximum(size, 0)]), step)
    # the wanted entry of step**n times n! / n**n; the powers are rescaled, the scale is kept as a logarithm
    out, log_out, power, log_power, left = np.eye(m), 0.0, step, 0.0, n
    while left:
        if left & 1:
            out = out @ power
            top = out[k - 1, k - 1]
            out, log_out = out / top, log_out + log_power + math.log(top)
        left >>= 1
        if left:
            power = power @ power
            top = power[k - 1, k - 1]
            power, log_power = power / top, 2 * log_power + math.log(top)
    return math.exp(log_out + math.log(out[k - 1, k - 1]) + math.lgamma(n + 1) - n * math.log(n))


def _inside_series(d: float, n: int) -> float:
    """P(D < d) of many values: the limit law and its corrections to the order n**-1.5."""
    z, pi2 = d * math.sqrt(n), math.pi**2
    k = np.arange(-40, 41)
    a, b = pi2 * (k + 0.5) ** 2, pi2 * k.astype(float) ** 2
    ea, eb = np.exp(-a / (2 * z * z)), np.exp(-b / (2 * z * z))
    half = math.sqrt(math.pi / 2)
    limit = math.sqrt(2 * math.pi) / z * ea[k >= 0].sum()
    first = half / (6 * z**4) * ((a - z * z) * ea).sum()
    second = (half / (72 * z**7) * ((6 * z**6 + 2 * z**4 + (2 * z**4 - 5 * z * z) * a + (1 - 2 * z * z) * a * a) * ea).sum()
              - half / (36 * z**3) * (b * eb).sum())
    third = (half / (6480 * z**10) * ((a**3 * (5 - 30 * z * z) + a * a * (-60 * z * z + 212 * z**4) + a * (135 * z**4 - 96 * z**6)
                                       - 30 * z**6 - 90 * z**8) * ea).sum()
             + half / (216 * z**6) * ((3 * b * z * z - b * b) * eb).sum())
    return limit + first / math.sqrt(n) + second / n + third / n**1.5


#: From here on sums over all values give way to expansions in 1 / n.
SUM_TERMS = 1_000_000
MATRIX_VALUES = 2_000
#: Grid points of two samples up to which all orders of the rows are counted.
EXACT_CELLS = 100_000_000


def two_sided_sf(d: float, n: int) -> float:
    """P(D >= d) of the one-sample statistic of n values.

    Where n d**2 >= 4 both bounds are hardly ever crossed together, and the sum of the
    one-sided probabilities is the answer to 11 digits; below, the probability is large
    enough to take it from that of staying inside."""
    if d is None or n is None or math.isnan(d) or n <= 0:
        return float("nan")
    if n * d <= 0.5:
        return 1.0
    if d >= 1:
        return 0.0
    if d >= 0.5 or n * d * d >= 4:
        return min(1.0, 2 * one_sided_sf(d, n))
    inside = _inside_matrix(d, n) if n <= MATRIX_VALUES else _inside_series(d, n)
    return min(1.0, max(0.0, 1.0 - inside))


def exact_two_sample_sf(d: float, m: int, n: int) -> float:
    """P(D >= d) for two samples of m and n values, all orders of the m + n rows alike likely.

    An order is a path from (0, 0) to (m, n); out(i, j) is the share of the paths to (i, j)
    that have left the band |i / m - j / n| < d. One diagonal i + j after the other; all terms
    are positive, so small probabilities keep their digits."""
    if d is None or m is None or n is None or math.isnan(d) or m <= 0 or n <= 0:
        return float("nan")
    m, n = min(m, n), max(m, n)
    bound = round(d * m * n)  # d is a multiple of 1 / (m n)
    if bound <= 0:
        return 1.0
    out = np.zeros(m + 2)  # out[i + 1] on the present diagonal
    for s in range(1, m + n + 1):
        lo, hi = max(0, s - n), min(m, s)
        i = np.arange(lo, hi + 1)
        j = s - i
        new = (out[lo:hi + 1] * i + out[lo + 1:hi + 2] * j) / s
        new[np.abs(i * n - j * m) >= bound] = 1.0
        out[lo + 1:hi + 2] = new
    return float(out[m + 1])


def ks_law(d: float, m: int, n: int, law: str) -> float:
    """Two-sided p-value of two samples: "exact" counts orders up to EXACT_CELLS = m n, beyond that and
    for "finite" the one-sample law at the rounded effective size m n / (m + n) is taken."""
    if d is None or m is None or n is None or math.isnan(d) or m <= 0 or n <= 0:
        return float("nan")
    if law == "exact" and m * n <= EXACT_CELLS:
        return exact_two_sample_sf(d, m, n)
    return two_sided_sf(d, round(m * n / (m + n)))


def ks_law_udf(law: str):
    @F.pandas_udf(T.DoubleType())
    def tail(d: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([ks_law(float(x), int(a), int(b), law) if pd.notna(x) and pd.notna(a) and pd.notna(b) and a > 0 and b > 0 else None
                          for x, a, b in zip(d, m, n)], dtype="float64")

    return tail


def kolmogorov_sf(lam: Column) -> Column:
    """P(K >= lam) of the Kolmogorov law, a JVM expression. From 1 on the series
    2 sum (-1)**(k-1) exp(-2 k**2 lam**2); below, 1 - sqrt(2 pi) / lam *
    sum exp(-(2k-1)**2 pi**2 / (8 lam**2)), which converges there. The sixth
    term of either is below 1e-30, so five give all digits."""
    ks = range(1, 6)
    above = sum((F.lit(2.0 * (-1.0) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam) for k in ks), F.lit(0.0))
    below = sum((F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8) / (lam * lam)) for k in ks), F.lit(0.0))
    p = F.when(lam < 1, F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * below).otherwise(above)
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)))


def ks_pvalue(d: Column, n1: Column, n2: Column, alternative: str = "two-sided", law: str = "limit") -> Column:
    """Two-sample KS p-value. Two-sided by ``law``: "limit" is the Kolmogorov law at
    D*sqrt(n1*n2/(n1+n2)), a JVM expression; "finite" the law of one sample of the rounded
    effective size; "exact" counts the orders of the rows (see ``ks_law``). One-sided:
    Hodges' approximation exp(-2z^2 - 2z(m+2n)/sqrt(mn(m+n))/3) with m >= n."""
    if alternative == "two-sided" and law != "limit":
        return ks_law_udf(law)(d, n1, n2)
    n1d, n2d = n1.cast("double"), n2.cast("double")
    en = n1d * n2d / (n1d + n2d)
    if alternative == "two-sided":
        return kolmogorov_sf(d * F.sqrt(en))
    m = F.greatest(n1d, n2d)
    n = F.least(n1d, n2d)
    z = F.sqrt(en) * d
    expt = F.lit(-2.0) * z * z - F.lit(2.0) * z * (m + F.lit(2.0) * n) / F.sqrt(m * n * (m + n)) / F.lit(3.0)
    return F.least(F.lit(1.0), F.exp(expt))
