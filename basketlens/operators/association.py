"""Crosstabs, chi-square independence and Cramér's V."""

from pyspark.sql import functions as F

from basketlens import config
from basketlens.functions import tails


def present_pairs(df, pairs):
    return [(a, b) for a, b in pairs if a in df.columns and b in df.columns]


def crosstab(df, a, b):
    """(a, b, n) of the combinations that occur, nulls excluded."""
    return df.na.drop(subset=[a, b]).groupBy(a, b).agg(F.count("*").alias("n"))


def crosstab_pivot(df, a, b, levels):
    """The crosstab with one column per given level of b and zeros for empty cells."""
    wide = df.na.drop(subset=[a, b]).groupBy(a).pivot(b, levels).agg(F.count(F.lit(1)))
    return wide.na.fill(0)


def pair_counts(df, pairs, by=()):
    """(by…, var1, var2, a, b, n) of every pair in one pass; levels as text."""
    pairs = present_pairs(df, pairs)
    cells = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                               F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
                      for a, b in pairs])
    return (df.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")
            .where("a IS NOT NULL AND b IS NOT NULL")
            .groupBy(*by, "var1", "var2", "a", "b").agg(F.count("*").alias("n")))


def chi_square(df, pairs=config.ASSOCIATION_PAIRS, by=()):
    """(by…, var1, var2, chi2, dof, n, levels1, levels2, cramers_v) for every pair.

    The rows are only scanned to count cells. An empty cell contributes its expected count, and
    those sum to n minus the expected counts of the occupied cells, so no cell is generated. In
    a 2×2 table every |observed − expected| is the same and the reciprocals of the expected
    counts factor into row and column sums, which gives Yates' correction the same way.
    """
    return association(pair_counts(df, pairs, by), by)


def association(cells, by=()):
    keys = [*by, "var1", "var2"]
    rows = cells.groupBy(*keys, "a").agg(F.sum("n").alias("row_n"))
    cols = cells.groupBy(*keys, "b").agg(F.sum("n").alias("col_n"))
    sides = rows.groupBy(*keys).agg(F.count("*").alias("levels1"), F.sum("row_n").alias("total"),
                                    F.sum(1 / F.col("row_n")).alias("inverse_rows"))
    other = cols.groupBy(*keys).agg(F.count("*").alias("levels2"),
                                    F.sum(1 / F.col("col_n")).alias("inverse_cols"))
    totals = sides.join(other, keys)
    # Without blocks there is one row of totals for each requested pair.
    expected = F.col("row_n") * F.col("col_n") / F.col("total")
    deviation = F.abs(F.col("n") - F.col("expected"))
    summed = (cells.join(rows, [*keys, "a"]).join(cols, [*keys, "b"]).join(totals if by else F.broadcast(totals), keys)
              .withColumn("expected", expected)
              .groupBy(*keys, "levels1", "levels2", "total", "inverse_rows", "inverse_cols")
              .agg(F.sum(deviation * deviation / F.col("expected")).alias("occupied"),
                   F.sum("expected").alias("covered"), F.max(deviation).alias("deviation")))
    dof = (F.col("levels1") - 1) * (F.col("levels2") - 1)
    corrected = F.col("deviation") - F.least(F.lit(0.5), F.col("deviation"))
    yates = corrected * corrected * F.col("total") * F.col("inverse_rows") * F.col("inverse_cols")
    chi2 = (F.when(dof == 0, 0.0).when(dof == 1, yates)
            .otherwise(F.col("occupied") + F.col("total") - F.col("covered")))
    smaller = F.least("levels1", "levels2") - 1
    return (summed.withColumn("chi2", chi2).select(
        *keys, "chi2", dof.alias("dof"), F.col("total").alias("n"), "levels1", "levels2",
        F.sqrt(F.col("chi2") / F.col("total") / F.nullif(smaller, F.lit(0))).alias("cramers_v")))


def with_chi_square_p(found):
    """Add the p-value; works on the small result table."""
    return found.withColumn("pvalue", tails.chi_square_tail("chi2", "dof"))


def chi_square_by_block(blocked, pairs=config.ASSOCIATION_PAIRS, block="block"):
    """chi_square per block of rows, averaged: (var1, var2, chi2, pvalue, dof, cramers_v, n_blocks)."""
    found = with_chi_square_p(chi_square(blocked, pairs, [block]))
    return found.groupBy("var1", "var2").agg(
        *[F.avg(c).alias(c) for c in ("chi2", "pvalue", "dof", "cramers_v")],
        F.count("*").alias("n_blocks"))
