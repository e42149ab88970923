"""Shapiro–Wilk W and p (Royston 1995, algorithm AS R94) as Columns: scores by rank, sums by group, arithmetic on the sums."""

import math

from pyspark.sql import functions as F

from basketlens.functions.normal import normal_cdf, normal_quantile

# Royston's published polynomial coefficients, highest power first.
WEIGHT_LAST = [-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0]
WEIGHT_NEXT = [-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0]
SMALL_GAMMA = [0.459, -2.273]
SMALL_MEAN = [-0.0006714, 0.025054, -0.39978, 0.5440]
SMALL_LOG_SD = [-0.0020322, 0.062767, -0.77857, 1.3822]
LARGE_MEAN = [0.0038915, -0.083751, -0.31082, -1.5861]
LARGE_LOG_SD = [0.0030302, -0.082676, -0.4803]
HEAVIEST = 99.0  # −log10 of the p given to samples beyond the small-sample range


def polynomial(coefficients, x):
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + c
    return total


def normal_score(rank, n):
    """Blom's approximate normal score of a 1-based rank among n values."""
    return normal_quantile((rank - 0.375) / (n + 0.25))


def with_w_and_p(sums):
    """Add ``w`` and ``p`` to sums over samples in ascending order; each step is a column that the next ones use.

    ``n``; ``scored``: sum of normal score times value; ``squares``: of squared scores; ``spread``: of squared deviations
    from the mean; ``ends``: last value minus first; ``next_ends``: last but one minus second. The weights are antisymmetric,
    proportional to the scores but for the two outermost pairs.
    """
    n, ends, beside = F.col("n"), F.col("ends"), F.col("next_ends")
    top, second, last, following = (F.col(c) for c in ("_top", "_second", "_last", "_following"))
    root = 1 / F.sqrt(n)
    step = sums.withColumns({"_top": normal_score(n, n), "_second": normal_score(n - 1, n)})
    step = step.withColumns({"_last": polynomial(WEIGHT_LAST, root) + top / F.sqrt("squares"),
                             "_following": polynomial(WEIGHT_NEXT, root) + second / F.sqrt("squares")})
    long_rest = (F.col("squares") - 2 * top * top - 2 * second * second) / (1 - 2 * last * last - 2 * following * following)
    short_rest = (F.col("squares") - 2 * top * top) / (1 - 2 * last * last)
    long = (F.col("scored") - top * ends - second * beside) / F.sqrt(long_rest) + following * beside + last * ends
    short = (F.col("scored") - top * ends) / F.sqrt(short_rest) + last * ends
    step = step.withColumn("_product", F.when(n == 3, math.sqrt(0.5) * ends).when(n > 5, long).otherwise(short))
    w = F.col("w")
    step = step.withColumn("w", F.when(ends == 0, 1.0).when(n >= 3, F.least(F.lit(1.0), F.col("_product") * F.col("_product") / F.col("spread"))))
    three = F.greatest(F.lit(0.0), 6 / math.pi * (F.asin(F.sqrt(w)) - math.asin(math.sqrt(0.75))))
    step = step.withColumns({"_y": F.log(1 - w), "_gamma": polynomial(SMALL_GAMMA, n), "_log": F.log(n)})
    small = (-F.log(F.col("_gamma") - F.col("_y")) - polynomial(SMALL_MEAN, n)) / F.exp(polynomial(SMALL_LOG_SD, n))
    large = (F.col("_y") - polynomial(LARGE_MEAN, F.col("_log"))) / F.exp(polynomial(LARGE_LOG_SD, F.col("_log")))
    step = step.withColumn("_z", -F.when(n <= 11, small).otherwise(large))
    p = (F.when(w.isNull(), F.lit(None).cast("double")).when(w >= 1, 1.0).when(n == 3, three)
         .when((n <= 11) & (F.col("_y") >= F.col("_gamma")), 10.0 ** -HEAVIEST).otherwise(normal_cdf(F.col("_z"))))
    return step.withColumn("p", p).select(*sums.columns, "w", "p")
