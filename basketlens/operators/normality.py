"""Shapiro–Wilk on bounded blocks, Kolmogorov–Smirnov on blocks and on the full data."""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketlens import config
from basketlens.functions import shapiro, tails
from basketlens.functions.normal import normal_cdf, normal_cdf_array, normal_quantile_array
from basketlens.functions.columns import number
from basketlens.operators import order_stats
from basketlens.operators.describe import per_column
from basketlens.operators.skew import with_blocks
from basketlens.sources.staging import materialize, temporary


def block_key(columns):
    """A hash of a row's values (to 1/1000) that has nothing to do with their order."""
    return F.md5(F.concat_ws("|", *[F.floor(F.col(c) * 1000).cast("string") for c in columns]))


@lru_cache(maxsize=256)
def _scores(n):
    """Blom's scores of a sample of n values in ascending order (see shapiro.normal_score)."""
    return normal_quantile_array((np.arange(1, n + 1) - 0.375) / (n + 0.25))


def _sums_of(values):
    """What both tests need of one sample; the distance is null where the values have no spread."""
    v = np.sort(values)
    n = v.size
    with np.errstate(invalid="ignore", over="ignore"):  # infinite values
        x = v - v.mean()
        spread = float(np.dot(x, x))
        score, ends = _scores(n), float(v[-1] - v[0])
        d = None
        if v[0] != v[-1]:
            cdf = normal_cdf_array(x / np.sqrt(spread / n))
            cdf[np.isnan(cdf)] = 1.0
            rank = np.arange(1, n + 1)
            d = float(np.maximum(rank / n - cdf, cdf - (rank - 1) / n).max())
        return (float(n), float(np.dot(score, x)), float(np.dot(score, score)), spread, ends,
                float(v[-2] - v[1]) if n > 1 else None, d)


def _sample_sums(columns):
    def run(key, block):
        rows = [(c, key[0].as_py(), *_sums_of(values)) for c in columns
                if len(values := block[c].drop_null().to_numpy())]
        names = ["variable", "block", "n", "scored", "squares", "spread", "ends", "next_ends", "d"]
        types = [pa.string(), pa.int64(), *[pa.float64()] * 7]
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)
    return run


def normality_blocks(df, columns, block_rows=config.BLOCK_ROWS):
    """(variable, block, n, shapiro_stat, shapiro_p, ks_stat, ks_p) of blocks of ``block_rows`` rows.

    Both tests are defined for small samples only, so rows are dealt into blocks: in the order of a hash of
    the used values, which has nothing to do with the values' order nor with the layout of the data. Equal
    rows are interchangeable, so every layout gives the same blocks. Wide rows are shuffled by block; a task takes one block after the
    other and sorts its columns, a bounded number of values each, into a few sums. The normal is fitted with the population deviation.
    The sums are written, one row for each column and block, and the sorted rows deleted.
    """
    wide = df.select(*[number(df, c).alias(c) for c in columns])
    with temporary(df.sparkSession) as keep:
        blocked = with_blocks(wide, [block_key(columns), *columns], block_rows, "block")
        sums = keep(materialize(blocked.select("block", *columns).groupBy("block").applyInArrow(
            _sample_sums(columns), "variable STRING, block BIGINT, n DOUBLE, scored DOUBLE, squares DOUBLE, spread DOUBLE, ends DOUBLE, "
                                   "next_ends DOUBLE, d DOUBLE")))
    found = shapiro.with_w_and_p(sums).withColumn("ks_stat", F.when(F.col("n") >= 3, F.col("d")))
    return found.select("variable", "block", F.col("n").cast("bigint").alias("n"), F.col("w").alias("shapiro_stat"),
                        F.col("p").alias("shapiro_p"), "ks_stat", tails.kolmogorov_tail("ks_stat", "n").alias("ks_p"))


def normality_table(df, columns, block_rows=config.BLOCK_ROWS):
    """(variable, n, n_blocks, shapiro_stat, shapiro_p, ks_stat, ks_p) averaged over blocks."""
    blocks = normality_blocks(df, columns, block_rows)
    return blocks.groupBy("variable").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_blocks"),
        *[F.avg(c).alias(c) for c in ("shapiro_stat", "shapiro_p", "ks_stat", "ks_p")])


def verdict(table, alpha=config.ALPHA):
    passes = (F.col("shapiro_p") > alpha) & (F.col("ks_p") > alpha)
    return table.withColumn("verdict", F.when(passes, config.NORMAL_NOT_REJECTED).otherwise(config.NORMAL_REJECTED))


def verdict_lines(judged):
    """One text line per column, for write_report."""
    text = F.concat(F.col("variable"), F.lit(": shapiro_p="), F.coalesce(F.col("shapiro_p").cast("string"), F.lit("nan")),
                    F.lit(", ks_p="), F.coalesce(F.col("ks_p").cast("string"), F.lit("nan")),
                    F.lit(" -> "), F.col("verdict"))
    return judged.select(text.alias("line"))


def ks_normal(df, columns):
    """(variable, n, ks_stat, ks_p) of the full column against the normal fitted to it.

    The largest step difference is taken over distinct values with their running counts.
    """
    fitted = per_column(df, columns, n=F.count, mean=F.avg, sd=F.stddev_pop)
    steps = order_stats.value_ranks(df, columns).join(F.broadcast(fitted), "variable").where("sd > 0")
    cdf = normal_cdf((F.col("value") - F.col("mean")) / F.col("sd"))
    gap = steps.withColumn("cdf", cdf).select("variable", F.greatest(
        F.col("cdf") - F.col("before") / F.col("n"),
        (F.col("before") + F.col("copies")) / F.col("n") - F.col("cdf")).alias("gap"))
    stat = gap.groupBy("variable").agg(F.max("gap").alias("ks_stat"))
    return fitted.join(F.broadcast(stat), "variable", "left").select(
        "variable", "n", "ks_stat", tails.kolmogorov_tail("ks_stat", F.col("n").cast("double")).alias("ks_p"))
