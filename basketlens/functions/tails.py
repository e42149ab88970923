"""Tail probabilities as Columns: series and continued fractions folded by ``aggregate``, no Python in the tasks.

They see small tables of test statistics. Where a number of steps depends on the arguments it grows with the square
root of the degrees of freedom, which is what these expansions need; logarithms of gamma functions of large arguments
only occur as differences, so that hundreds of millions of degrees of freedom keep their digits.
"""

import math

import numpy as np
from pyspark.sql import functions as F

from basketlens.functions.normal import normal_cdf, normal_cdf_array

TINY = 1e-300
SHIFT = 10  # Stirling's series starts from here
SCALE_NODES, VALUE_NODES = 96, 128  # of the studentized range
REACH = 8.5  # standard deviations
BISECTIONS = 48
MOST_STEPS = 100_000
LOPSIDED = 1e6  # from this parameter on the continued fraction loses digits, if the other one is small


def _let(use, **values):
    """``use(values)`` with each value computed once."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), use)[0]


def _double(value):
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def _steps(size):
    return F.sequence(F.lit(1), F.least(F.ceil(size), F.lit(MOST_STEPS)).cast("int"))


def _stirling(z):
    """ln Γ(z) − ((z − 1/2) ln z − z + ln(2π)/2), for z of at least ``SHIFT``."""
    square = 1 / (z * z)
    return (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square / 1188)))) / z


def log_gamma(z):
    """ln Γ(z) of a positive Column."""
    far = z + SHIFT
    product = z
    for k in range(1, SHIFT):
        product = product * (z + k)
    return (far - 0.5) * F.log(far) - far + 0.5 * math.log(2 * math.pi) + _stirling(far) - F.log(product)


def log_gamma_rise(b, a):
    """ln Γ(b + a) − ln Γ(b), without losing the digits of a large b."""
    far = b + SHIFT
    shrink = F.lit(0.0)
    for k in range(SHIFT):
        shrink = shrink + F.log1p(a / (b + k))
    return (far - 0.5) * F.log1p(a / far) + a * F.log(far + a) - a + _stirling(far + a) - _stirling(far) - shrink


def _away_from_zero(value):
    return F.when(F.abs(value) > TINY, value).otherwise(TINY)


def _lentz(numerators, steps, b):
    """b0 + a1 / (b1 + a2 / …) by Lentz's method; ``numerators(m)`` and ``b(m)`` list the terms of step m."""
    def step(state, m):
        for a, term in zip(numerators(m), b(m)):
            state = _let(lambda v: F.struct(v["c"].alias("c"), (1 / v["d"]).alias("d"), (v["h"] * v["c"] / v["d"]).alias("h")),
                         c=_away_from_zero(term + a / state["c"]), d=_away_from_zero(term + a * state["d"]), h=state["h"])
        return state
    return steps, step


def gamma_upper(a, x):
    """Regularized upper incomplete gamma function of two Columns."""
    small = -x + a * F.log(x) - log_gamma(a)
    ratio = (x - a) / a
    large = a * (F.log1p(ratio) - ratio) + 0.5 * F.log(a) - 0.5 * math.log(2 * math.pi) - _stirling(a)

    def summed(v):
        first = F.struct((1 / v["a"]).alias("term"), (1 / v["a"]).alias("total"))
        term = lambda s, n: s["term"] * v["x"] / (v["a"] + n)
        series = F.aggregate(v["steps"], first, lambda s, n: F.struct(
            term(s, n).alias("term"), (s["total"] + term(s, n)).alias("total")), lambda s: s["total"])
        steps, step = _lentz(lambda i: [-i * (i - v["a"])], v["steps"], lambda i: [v["x"] + 2 * i + 1 - v["a"]])
        start = 1 / _away_from_zero(v["x"] + 1 - v["a"])
        fraction = F.aggregate(steps, F.struct(F.lit(1 / TINY).alias("c"), start.alias("d"), start.alias("h")), step, lambda s: s["h"])
        return F.when(v["x"] < v["a"] + 1, 1 - series * v["scale"]).otherwise(fraction * v["scale"])

    value = _let(summed, a=a, x=x, scale=F.exp(F.when(a < 20, small).otherwise(large)), steps=_steps(200 + 10 * F.sqrt(a)))
    return F.when(x <= 0, 1.0).when(x == float("inf"), 0.0).otherwise(value)


def beta_upper(x, y, a, b):
    """P(X > x) of a beta distribution, with y = 1 − x given, so that neither loses digits."""
    low, high = F.least(a, b), F.greatest(a, b)
    # Of x and y the one near 1 has its logarithm from the other.
    log_x = F.when(x > 0.5, F.log1p(-y)).otherwise(F.log(x))
    log_y = F.when(x > 0.5, F.log(y)).otherwise(F.log1p(-x))
    front = F.exp(a * log_x + b * log_y + log_gamma_rise(high, low) - log_gamma(low))

    def value(v):
        p, q, z = v["p"], v["q"], v["z"]
        steps, step = _lentz(
            lambda m: [m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))],
            _steps(200 + 6 * F.sqrt(F.greatest(p, q))), lambda m: [F.lit(1.0), F.lit(1.0)])
        start = 1 / _away_from_zero(1 - (p + q) * z / (p + 1))
        fraction = F.aggregate(steps, F.struct(F.lit(1.0).alias("c"), start.alias("d"), start.alias("h")), step, lambda s: s["h"])
        return v["front"] / p * fraction

    left = x < (a + 1) / (a + b + 2)
    part = _let(value, p=F.when(left, a).otherwise(b), q=F.when(left, b).otherwise(a), z=F.when(left, x).otherwise(y), front=front)

    def series(v):
        # The lower tail of the small parameter's side: positive terms, about as many as their mean.
        p, q, z = v["p"], v["q"], v["z"]
        mean = (p + q) * z
        grown = F.aggregate(_steps(mean + 12 * F.sqrt(mean) + 80), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")), lambda s, n: _let(
            lambda t: F.struct(t["term"].alias("term"), (t["total"] + t["term"]).alias("total")),
            term=s["term"] * (p + q + n - 1) / (p + n) * z, total=s["total"]), lambda s: s["total"])
        return F.when(mean > 2_000 + 20 * p, 1.0).otherwise(v["front"] / p * grown)

    small_a = a < b
    lower = _let(series, p=low, q=high, z=F.when(small_a, x).otherwise(y), front=front)
    lopsided = F.when(small_a, F.greatest(F.lit(0.0), 1 - lower)).otherwise(lower)
    return (F.when(x <= 0, 1.0).when(y <= 0, 0.0).when((high > LOPSIDED) & (low < 1e4), lopsided)
            .when(left, 1 - part).otherwise(part))


def chi_square_tail(x, dof):
    x, dof = _double(x), _double(dof)
    return F.when(dof == 0, F.when(x.isNotNull(), 1.0)).otherwise(gamma_upper(dof / 2, x / 2))


def f_tail(f, d1, d2):
    f, d1, d2 = _double(f), _double(d1), _double(d2)
    part = _let(lambda v: beta_upper(v["d1"] * v["f"] / (v["d2"] + v["d1"] * v["f"]), v["d2"] / (v["d2"] + v["d1"] * v["f"]),
                                     v["d1"] / 2, v["d2"] / 2), f=f, d1=d1, d2=d2)
    return F.when(f == float("inf"), 0.0).when(f.isNotNull() & (d1 > 0) & (d2 > 0), part)


def correlation_tail(r, n):
    """Two-sided p of a correlation coefficient, t with n − 2 degrees of freedom; null below three rows."""
    r, n = _double(r), _double(n)
    part = _let(lambda v: beta_upper(v["r"] * v["r"], (1 - v["r"]) * (1 + v["r"]), F.lit(0.5), (v["n"] - 2) / 2), r=r, n=n)
    return F.when(n < 3, F.lit(None).cast("double")).when(F.abs(r) >= 1, 0.0).when(r.isNotNull(), part)


def kolmogorov_tail(d, n):
    """Two-sided one-sample Kolmogorov–Smirnov tail: limit law with Vrbik's finite-n shift."""
    d, n = _double(d), _double(n)
    root = F.sqrt(n)
    z = d * root
    total = lambda last, term: F.aggregate(F.sequence(F.lit(1), F.lit(last)), F.lit(0.0), lambda s, k: s + term(k))

    def value(v):
        z = v["z"]
        near = 1 - math.sqrt(2 * math.pi) / z * total(20, lambda k: F.exp(-(2 * k - 1) * (2 * k - 1) * math.pi ** 2 / (8 * z * z)))
        far = 2 * total(100, lambda k: (1 - 2 * ((k - 1) % 2)) * F.exp(-2 * k * k * z * z))
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(z <= 0, 1.0).when(z < 1.18, near).otherwise(far)))

    return F.when(d.isNotNull(), _let(value, z=z + 1 / (6 * root) + (z - 1) / (4 * n)))


# ---- the studentized range --------------------------------------------------------------

def _nodes(n):
    """Gauss–Legendre nodes and weights on [-1, 1]."""
    return [a.tolist() for a in np.polynomial.legendre.leggauss(n)]


def _range_tail(q, k, dof):
    """The range of k normals over an independent scale: a sum over scales of sums over values, both by fixed nodes."""
    x, wx = _nodes(SCALE_NODES)
    scales = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(w).alias("w")) for a, w in zip(x, wx)])
    y, wy = _nodes(VALUE_NODES)
    z = [REACH * a for a in y]
    weight = [REACH * w * math.exp(-a * a / 2) / math.sqrt(2 * math.pi) for a, w in zip(z, wy)]
    values = F.array(*[F.struct(F.lit(a).alias("z"), F.lit(c).alias("cdf"), F.lit(w).alias("w"))
                       for a, c, w in zip(z, normal_cdf_array(z).tolist(), weight)])

    def tail(v):
        # Scales 1 + t within the reach of the scale's deviation; below zero there are none.
        low = F.greatest(F.lit(1e-12 - 1), -v["spread"])

        def over_scales(state, node):
            t = (v["spread"] - low) / 2 * node["x"] + (v["spread"] + low) / 2

            def weighed(s):
                # The scale's density, up to a factor that the division by the total takes out.
                share = node["w"] * F.exp(v["dof"] * (F.log1p(s["t"]) - s["t"] - s["t"] * s["t"] / 2) - F.log1p(s["t"]))
                inner = F.aggregate(values, F.lit(0.0), lambda total, n: total + n["w"] * F.pow(
                    F.greatest(F.lit(0.0), n["cdf"] - normal_cdf(n["z"] - v["q"] * (1 + s["t"]))), v["k"] - 1))
                return F.struct((state["sum"] + share * v["k"] * inner).alias("sum"), (state["all"] + share).alias("all"))
            return _let(weighed, t=t)

        first = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("all"))
        inside = F.aggregate(scales, first, over_scales, lambda s: s["sum"] / s["all"])
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - inside))

    return _let(tail, q=q, k=k, dof=dof, spread=REACH / F.sqrt(2 * dof))


def studentized_range_tail(q, k, dof):
    """Upper tail of the studentized range of k groups with the given degrees of freedom."""
    q, k, dof = _double(q), _double(k), _double(dof)
    return F.when(q <= 0, 1.0).when(q.isNotNull() & (dof > 0), _range_tail(q, k, dof))


def studentized_range_quantile(p, k, dof):
    """The q whose upper tail is 1 − p, by halving the logarithm's range from 1/1000 to 10,000 (to 12 digits)."""
    p, k, dof = _double(p), _double(k), _double(dof)

    def halved(state, _):
        middle = (state["low"] + state["high"]) / 2
        above = _range_tail(F.exp(middle), state["k"], state["dof"]) > 1 - state["p"]
        return _let(lambda v: F.struct(F.when(v["above"], v["middle"]).otherwise(v["low"]).alias("low"),
                                       F.when(v["above"], v["high"]).otherwise(v["middle"]).alias("high"),
                                       v["p"].alias("p"), v["k"].alias("k"), v["dof"].alias("dof")),
                    above=above, middle=middle, low=state["low"], high=state["high"], p=state["p"], k=state["k"], dof=state["dof"])

    first = F.struct(F.lit(math.log(1e-3)).alias("low"), F.lit(math.log(1e4)).alias("high"), p.alias("p"), k.alias("k"), dof.alias("dof"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(BISECTIONS)), first, halved, lambda s: F.exp((s["low"] + s["high"]) / 2))
    return F.when(dof > 0, found)
