"""Shapiro–Wilk W and p of one bounded block (Royston 1995, algorithm AS R94)."""

import math
from functools import lru_cache

import numpy as np

from scalar_tails import NORMAL

# Royston's published polynomial coefficients, highest power first.
WEIGHT_LAST = [-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0]
WEIGHT_NEXT = [-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0]
SMALL_GAMMA = [0.459, -2.273]
SMALL_MEAN = [-0.0006714, 0.025054, -0.39978, 0.5440]
SMALL_LOG_SD = [-0.0020322, 0.062767, -0.77857, 1.3822]
LARGE_MEAN = [0.0038915, -0.083751, -0.31082, -1.5861]
LARGE_LOG_SD = [0.0030302, -0.082676, -0.4803]


@lru_cache(maxsize=64)
def weights(n):
    """Antisymmetric weights of the ordered sample."""
    if n == 3:
        return np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    m = np.array([NORMAL.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    squares = float(m @ m)
    u = 1 / math.sqrt(n)
    last = np.polyval(WEIGHT_LAST, u) + m[-1] / math.sqrt(squares)
    a = m.copy()
    if n > 5:
        following = np.polyval(WEIGHT_NEXT, u) + m[-2] / math.sqrt(squares)
        rest = (squares - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last ** 2 - 2 * following ** 2)
        a /= math.sqrt(rest)
        a[-2], a[1] = following, -following
    else:
        a /= math.sqrt((squares - 2 * m[-1] ** 2) / (1 - 2 * last ** 2))
    a[-1], a[0] = last, -last
    return a


def shapiro_wilk(values):
    """(W, p); (nan, nan) below three values, (1, 1) for a constant sample."""
    x = np.sort(np.asarray(values, dtype=float))
    n = x.size
    if n < 3 or not np.isfinite(x).all():
        return math.nan, math.nan
    if x[-1] == x[0]:
        return 1.0, 1.0
    x = (x - x[n // 2]) / (x[-1] - x[0])
    centred = x - x.mean()
    w = min(1.0, float(weights(n) @ x) ** 2 / float(centred @ centred))
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return w, max(0.0, p)
    if w >= 1.0:
        return w, 1.0
    y = math.log(1 - w)
    if n <= 11:
        gamma = np.polyval(SMALL_GAMMA, n)
        if y >= gamma:
            return w, 1e-99
        y = -math.log(gamma - y)
        mean, sd = np.polyval(SMALL_MEAN, n), math.exp(np.polyval(SMALL_LOG_SD, n))
    else:
        logn = math.log(n)
        mean, sd = np.polyval(LARGE_MEAN, logn), math.exp(np.polyval(LARGE_LOG_SD, logn))
    return w, 0.5 * math.erfc((y - mean) / sd / math.sqrt(2))
