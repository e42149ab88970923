"""Descriptive statistics and frequency tables, one pass for all columns."""

from pyspark.sql import functions as F

from basketlens import config
from basketlens.config import present
from basketlens.functions.columns import number
from basketlens.operators import order_stats

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def per_column(df, columns, **aggregates):
    """One row per column with the named aggregates; a single pass, no row is repeated."""
    one = df.agg(*[F.struct(*[f(number(df, c)).alias(name) for name, f in aggregates.items()]).alias(c)
                   for c in columns])
    return one.unpivot([], columns, "variable", "s").select("variable", "s.*")


def describe(df, columns):
    """(variable, n, mean, std, min, q1, median, q3, max) with exact quartiles."""
    columns = present(df, columns)
    basics = per_column(df, columns, n=F.count, mean=F.avg, std=F.stddev_samp, min=F.min, max=F.max)
    # Both sides hold one row per requested column.
    quartiles = order_stats.quantiles_wide(df, columns, QUARTILES)
    return basics.join(F.broadcast(quartiles), "variable", "left").select(
        "variable", "n", "mean", "std", "min", "q1", "median", "q3", "max")


def full_statistics(df, columns):
    """describe() plus mode, range, IQR, variance, coefficient of variation, skewness, kurtosis.

    The mode includes nulls when they are the most frequent; skewness and (excess) kurtosis are
    the biased moments.
    """
    columns = present(df, columns)
    moments = per_column(df, columns, mean=F.avg, min=F.min, max=F.max, std=F.stddev_samp,
                         variance=F.var_samp, skewness=F.skewness, kurtosis=F.kurtosis)
    quartiles = order_stats.quantiles_wide(df, columns, QUARTILES)
    modes = order_stats.numeric_modes(df, columns, keep_null=True).select("variable", "mode")
    joined = (moments.join(F.broadcast(quartiles), "variable", "left")
              .join(F.broadcast(modes), "variable", "left"))
    return joined.select(
        "variable", "mean", "median", "mode", "min", "max", (F.col("max") - F.col("min")).alias("range"),
        "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"), "std", "variance",
        (F.col("std") / F.nullif(F.col("mean"), F.lit(0.0))).alias("variation"), "skewness", "kurtosis")


def frequencies(df, columns):
    """(variable, value as text, n) of all columns, most frequent first, nulls included."""
    return order_stats.value_counts(df, present(df, columns)).orderBy("variable", F.desc("n"), "value")


def top_frequencies(df, column, k=config.TOP_FREQUENCIES):
    """The k most frequent non-null values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(k)


def day_frequencies(df, ts="ts", k=config.TOP_FREQUENCIES):
    """The k days with the most rows; all days when k is None."""
    days = (df.where(F.col(ts).isNotNull()).groupBy(F.date_trunc("day", ts).alias("day"))
            .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "day"))
    return days if k is None else days.limit(k)
