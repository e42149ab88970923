"""Tail probabilities as plain functions of numbers: what the Column forms are held against."""

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np

from basketlens.functions.normal import normal_cdf_array

NORMAL = NormalDist()


def gamma_upper(a, x):
    """Regularized upper incomplete gamma function (series below a + 1, continued fraction above)."""
    if math.isnan(x) or math.isnan(a):
        return math.nan
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * scale
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


def beta_lower(a, b, x):
    """Regularized incomplete beta function by Lentz's continued fraction."""
    if math.isnan(x) or x <= 0:
        return math.nan if math.isnan(x) else 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_lower(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100_000):
        for numerator in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                          -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + numerator * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + numerator / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi_square_sf(x, dof):
    return 1.0 if dof == 0 else gamma_upper(dof / 2, x / 2)


def f_sf(f, d1, d2):
    if math.isinf(f):
        return 0.0
    return beta_lower(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def t_two_sided(t, dof):
    return 0.0 if math.isinf(t) else beta_lower(dof / 2, 0.5, dof / (dof + t * t))


def correlation_p(r, n):
    """Two-sided p of a correlation coefficient, t with n − 2 degrees of freedom."""
    if math.isnan(r) or n < 3:
        return math.nan
    if abs(r) >= 1:
        return 0.0
    dof = n - 2
    return t_two_sided(r * math.sqrt(dof / (1 - r * r)), dof)


def kolmogorov_sf(d, n):
    """Two-sided one-sample Kolmogorov–Smirnov tail: limit law with Vrbik's finite-n shift."""
    if math.isnan(d):
        return math.nan
    root = math.sqrt(n)
    z = d * root
    z += 1 / (6 * root) + (z - 1) / (4 * n)
    if z <= 0:
        return 1.0
    if z < 1.18:
        cdf = math.sqrt(2 * math.pi) / z * sum(
            math.exp(-((2 * k - 1) ** 2) * math.pi ** 2 / (8 * z * z)) for k in range(1, 21))
        return min(1.0, max(0.0, 1.0 - cdf))
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * (k * z) ** 2) for k in range(1, 101))))


@lru_cache(maxsize=None)
def _legendre(n):
    return np.polynomial.legendre.leggauss(n)


def studentized_range_sf(q, k, dof):
    """Upper tail of the studentized range: the range of k normals over an independent scale."""
    if math.isnan(q) or q <= 0:
        return math.nan if math.isnan(q) else 1.0
    spread = 8.5 / math.sqrt(2 * dof)
    low, high = max(1e-12, 1 - spread), 1 + spread
    x, wx = _legendre(96)
    s = (high - low) / 2 * x + (high + low) / 2
    log_density = (math.log(2) + dof / 2 * math.log(dof / 2) - math.lgamma(dof / 2)
                   + (dof - 1) * np.log(s) - dof * s * s / 2)
    ws = wx * (high - low) / 2 * np.exp(log_density)
    y, wy = _legendre(128)
    z, wz = 8.5 * y, 8.5 * wy
    inner = normal_cdf_array(z)[None, :] - normal_cdf_array(z[None, :] - q * s[:, None])
    density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    range_cdf = k * (np.clip(inner, 0, 1) ** (k - 1) * (density * wz)[None, :]).sum(axis=1)
    total = ws.sum()
    return float(min(1.0, max(0.0, 1.0 - (ws * range_cdf).sum() / total)))


@lru_cache(maxsize=4096)
def studentized_range_ppf(p, k, dof):
    low, high = 0.0, 1.0
    while studentized_range_sf(high, k, dof) > 1 - p:
        low, high = high, high * 2
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if studentized_range_sf(mid, k, dof) > 1 - p else (low, mid)
    return (low + high) / 2


def filliben(rank, n):
    """Filliben's median plotting positions of the given 1-based ranks."""
    rank = np.asarray(rank, dtype=float)
    last = 0.5 ** (1.0 / n)
    return np.where(rank == 1, 1 - last, np.where(rank == n, last, (rank - 0.3175) / (n + 0.365)))
