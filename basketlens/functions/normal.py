"""The normal distribution as plain arithmetic: for Columns, NumPy arrays, and SQL text.

The cumulative probability is Hart's rational approximation, the quantile Wichura's AS 241; both
are good to about 1e-15 and stay inside generated code.
"""

import numpy as np
from pyspark.sql import Column, functions as F

# Published coefficients, highest power first.
CDF_ABOVE = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871,
             221.213596169931, 220.206867912376]
CDF_BELOW = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674,
             637.333633378831, 793.826512519948, 440.413735824752]
CDF_LIMIT = 7.07106781186547
MIDDLE_ABOVE = [2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
                1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0]
MIDDLE_BELOW = [5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
                5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0]
NEAR_ABOVE = [7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
              3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0]
NEAR_BELOW = [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
              6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0]
FAR_ABOVE = [2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
             2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0]
FAR_BELOW = [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
             1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0]


def _polynomial(x, coefficients):
    total = coefficients[0] * x + coefficients[1]
    for c in coefficients[2:]:
        total = total * x + c
    return total


def normal_cdf(z):
    """P(Z <= z) of a Column."""
    z = z if isinstance(z, Column) else F.col(z)
    x = F.abs(z)
    density = F.exp(-x * x / 2)
    near = density * _polynomial(x, CDF_ABOVE) / _polynomial(x, CDF_BELOW)
    far = density / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65))))) / 2.506628274631
    tail = F.when(x > 37, 0.0).when(x < CDF_LIMIT, near).otherwise(far)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def normal_cdf_array(z):
    z = np.asarray(z, dtype=float)
    x = np.minimum(np.abs(z), 38.0)
    density = np.exp(-x * x / 2)
    near = density * _polynomial(x, CDF_ABOVE) / _polynomial(x, CDF_BELOW)
    far = density / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65))))) / 2.506628274631
    tail = np.where(x > 37, 0.0, np.where(x < CDF_LIMIT, near, far))
    return np.where(z > 0, 1 - tail, tail)


def normal_quantile(p):
    """The z with P(Z <= z) = p of a Column; null unless 0 < p < 1."""
    p = p if isinstance(p, Column) else F.col(p)
    q = p - 0.5
    r = 0.180625 - q * q
    middle = q * _polynomial(r, MIDDLE_ABOVE) / _polynomial(r, MIDDLE_BELOW)
    t = F.sqrt(-F.log(F.least(p, 1 - p)))
    near = _polynomial(t - 1.6, NEAR_ABOVE) / _polynomial(t - 1.6, NEAR_BELOW)
    far = _polynomial(t - 5, FAR_ABOVE) / _polynomial(t - 5, FAR_BELOW)
    outer = F.when(t <= 5, near).otherwise(far)
    value = F.when(F.abs(q) <= 0.425, middle).when(q < 0, -outer).otherwise(outer)
    return F.when((p > 0) & (p < 1), value)


def normal_quantile_array(p):
    p = np.asarray(p, dtype=float)
    q = p - 0.5
    r = 0.180625 - q * q
    middle = q * _polynomial(r, MIDDLE_ABOVE) / _polynomial(r, MIDDLE_BELOW)
    t = np.sqrt(-np.log(np.minimum(p, 1 - p)))
    near = _polynomial(t - 1.6, NEAR_ABOVE) / _polynomial(t - 1.6, NEAR_BELOW)
    far = _polynomial(t - 5, FAR_ABOVE) / _polynomial(t - 5, FAR_BELOW)
    outer = np.where(t <= 5, near, far)
    return np.where(np.abs(q) <= 0.425, middle, np.where(q < 0, -outer, outer))


# ---- the same in SQL, for checks --------------------------------------------------------

def _polynomial_sql(x, coefficients):
    text = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        text = f"({text} * ({x}) + {c!r}::DOUBLE)"
    return text


def normal_cdf_sql(z):
    x = f"abs({z})"
    tail = (f"CASE WHEN {x} < {CDF_LIMIT} THEN exp(-{x} * {x} / 2) * {_polynomial_sql(x, CDF_ABOVE)} / "
            f"{_polynomial_sql(x, CDF_BELOW)} ELSE 0 END")
    return f"CASE WHEN {z} > 0 THEN 1 - ({tail}) ELSE {tail} END"


def normal_quantile_sql(p):
    r, t = f"(0.180625::DOUBLE - ({p} - 0.5) * ({p} - 0.5))", f"(sqrt(-ln(least({p}, 1 - {p}))) - 1.6)"
    middle = f"({p} - 0.5) * {_polynomial_sql(r, MIDDLE_ABOVE)} / {_polynomial_sql(r, MIDDLE_BELOW)}"
    near = f"{_polynomial_sql(t, NEAR_ABOVE)} / {_polynomial_sql(t, NEAR_BELOW)}"
    return f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN {middle} WHEN {p} < 0.5 THEN -({near}) ELSE {near} END"
