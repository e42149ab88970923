"""Tail functions against published table values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import scalar_tails as tails
from scalar_shapiro import shapiro_wilk
from basketlens.functions import tails as columns


@pytest.mark.parametrize("x, dof, p", [(3.841, 1, 0.05), (18.307, 10, 0.05), (124.342, 100, 0.05), (6.635, 1, 0.01)])
def test_chi_square(x, dof, p):
    assert tails.chi_square_sf(x, dof) == pytest.approx(p, abs=2e-5)


@pytest.mark.parametrize("f, d1, d2, p", [(3.478, 4, 10, 0.05), (4.965, 1, 10, 0.05), (2.606, 3, 1_000_000, 0.05)])
def test_f(f, d1, d2, p):
    assert tails.f_sf(f, d1, d2) == pytest.approx(p, abs=2e-4)


@pytest.mark.parametrize("t, dof, p", [(2.228, 10, 0.05), (12.706, 1, 0.05), (1.960, 10_000_000, 0.05)])
def test_t(t, dof, p):
    assert tails.t_two_sided(t, dof) == pytest.approx(p, abs=5e-5)


@pytest.mark.parametrize("k, dof, q", [(3, 10, 3.877), (5, 5, 5.673), (3, 1, 26.976), (10, 120, 4.560), (2, 20, 2.950)])
def test_studentized_range(k, dof, q):
    assert tails.studentized_range_ppf(0.95, k, dof) == pytest.approx(q, abs=2e-3)


@pytest.mark.parametrize("d, n, p", [(0.13403, 100, 0.05), (0.40925, 10, 0.05), (0.16081, 100, 0.01)])
def test_kolmogorov(d, n, p):
    assert tails.kolmogorov_sf(d, n) == pytest.approx(p, abs=2e-3)


def test_correlation_p():
    assert tails.correlation_p(0.632, 10) == pytest.approx(0.05, abs=2e-4)
    assert tails.correlation_p(1.0, 10) == 0.0
    assert math.isnan(tails.correlation_p(0.5, 2))


def test_shapiro_published_example():
    w, p = shapiro_wilk([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert w == pytest.approx(0.7888, abs=1e-3)
    assert p == pytest.approx(0.0067, abs=1e-3)


def test_shapiro_tells_normal_from_skewed():
    draws = np.random.default_rng(1)
    assert shapiro_wilk(draws.normal(size=3000))[1] > 0.05
    assert shapiro_wilk(draws.exponential(size=3000))[1] < 1e-6


def test_shapiro_edges():
    assert shapiro_wilk([1.0, 1.0, 1.0, 1.0]) == (1.0, 1.0)
    assert all(math.isnan(x) for x in shapiro_wilk([1.0, 2.0]))


# ---- the Column forms against the plain ones -------------------------------------------

def both(spark, rows, column, plain):
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], ", ".join(f"x{i} DOUBLE" for i in range(len(rows[0]))))
    for r in df.withColumn("p", column(*df.columns)).collect():
        want = plain(*r[:-1])
        assert (r["p"] is None) if math.isnan(want) else r["p"] == pytest.approx(want, rel=1e-7, abs=1e-10), r


def test_chi_square_column(spark):
    both(spark, [(x, d) for x in (0.0, 1e-3, 1.0, 3.8, 30.0, 500.0, 5e4, math.inf) for d in (0, 1, 4, 36, 200, 5e4)],
         columns.chi_square_tail, tails.chi_square_sf)


def test_f_column(spark):
    both(spark, [(f, a, b) for f in (0.0, 1e-3, 0.9, 3.0, 80.0, math.inf) for a in (1, 4, 90) for b in (1, 10, 59_000)],
         columns.f_tail, tails.f_sf)


def test_correlation_column(spark):
    both(spark, [(r, n) for r in (-1.0, -0.9, -0.01, 0.0, 0.3, 0.999, 1.0) for n in (2, 3, 10, 60_000)],
         columns.correlation_tail, tails.correlation_p)


def test_kolmogorov_column(spark):
    both(spark, [(d, n) for d in (1e-4, 0.01, 0.05, 0.3, 0.9) for n in (3, 100, 60_000)], columns.kolmogorov_tail, tails.kolmogorov_sf)


def test_studentized_range_columns(spark):
    both(spark, [(q, k, d) for q in (0.0, 0.5, 3.5, 9.0) for k, d in ((2, 1), (3, 12), (10, 58_000))],
         columns.studentized_range_tail, tails.studentized_range_sf)
    both(spark, [(0.95, 3, 12), (0.9, 5, 58_000)], columns.studentized_range_quantile, tails.studentized_range_ppf)


def test_many_degrees_of_freedom(spark):
    """Beyond the plain forms' digits: the limits for very large tables."""
    huge = 1e11
    df = spark.createDataFrame([(2.0, huge)], "x DOUBLE, d DOUBLE")
    r = df.select(columns.f_tail("x", F.lit(4), "d").alias("f"), columns.chi_square_tail(F.col("x") * 4, F.lit(4)).alias("c"),
                  columns.correlation_tail(F.lit(1.96) / F.sqrt("d"), F.col("d")).alias("r"),
                  columns.studentized_range_tail(F.lit(3.633), F.lit(4), "d").alias("q"),
                  columns.chi_square_tail(F.col("d") + 2 * F.sqrt(2 * F.col("d")), "d").alias("n")).first()
    assert r["f"] == pytest.approx(r["c"], rel=1e-8) and r["r"] == pytest.approx(0.0499958, rel=1e-5)
    assert r["q"] == pytest.approx(0.05, abs=2e-5) and r["n"] == pytest.approx(0.02275, abs=2e-5)


def test_nothing_gives_null(spark):
    none = F.lit(None).cast("double")
    found = [columns.chi_square_tail(none, F.lit(3)), columns.f_tail(none, F.lit(3), F.lit(4)), columns.correlation_tail(none, F.lit(9)),
             columns.kolmogorov_tail(none, F.lit(9)), columns.studentized_range_tail(none, F.lit(3), F.lit(9))]
    assert list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(found)]).first()) == [None] * 5
