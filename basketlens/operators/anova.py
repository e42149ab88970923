"""One-way analysis of variance and Tukey's pairwise comparison."""

from pyspark.sql import functions as F

from basketlens import config
from basketlens.config import present
from basketlens.functions import tails
from basketlens.functions.columns import number


def group_stats(df, value=config.ANOVA_VALUE, factors=config.ANOVA_FACTORS, by=()):
    """(by…, factor, level, n, mean, variance) for all factors in one pass, map-side combined."""
    factors = present(df, factors)
    levels = F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).cast("string").alias("level"))
                       for f in factors])
    rows = df.select(*by, number(df, value).alias("x"), F.explode(levels).alias("l"))
    return (rows.where("x IS NOT NULL AND l.level IS NOT NULL")
            .groupBy(*by, F.col("l.factor").alias("factor"), F.col("l.level").alias("level"))
            .agg(F.count("*").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("variance")))


def one_way(stats, by=()):
    """(by…, factor, n_groups, n, df_between, df_within, ms_within, f_stat) from group_stats.

    A single group has no F; it is null.
    """
    keys = [*by, "factor"]
    grand = stats.groupBy(*keys).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    away = F.col("mean") - F.col("grand")
    sums = stats.join(grand, keys).groupBy(*keys).agg(
        F.count("*").alias("n_groups"), F.sum("n").alias("n"),
        F.sum(F.col("n") * away * away).alias("ss_between"),
        F.sum(F.col("n") * F.col("variance")).alias("ss_within"))
    between, within = F.col("n_groups") - 1, F.col("n") - F.col("n_groups")
    ms_within = F.col("ss_within") / F.nullif(within, F.lit(0))
    return sums.select(
        *keys, "n_groups", "n", between.alias("df_between"), within.alias("df_within"),
        ms_within.alias("ms_within"),
        (F.col("ss_between") / F.nullif(between, F.lit(0)) / F.nullif(ms_within, F.lit(0.0))).alias("f_stat"))


def anova(df, value=config.ANOVA_VALUE, factors=config.ANOVA_FACTORS):
    return one_way(group_stats(df, value, factors))


def with_anova_p(found):
    return found.withColumn("pvalue", tails.f_tail("f_stat", "df_between", "df_within"))


def anova_by_block(blocked, value=config.ANOVA_VALUE, factors=config.ANOVA_FACTORS, block="block"):
    """The F test per block of rows, averaged: (factor, f_stat, pvalue, n_groups, n_blocks)."""
    found = with_anova_p(one_way(group_stats(blocked, value, factors, [block]), [block]))
    return found.where("n_groups >= 2").groupBy("factor").agg(
        F.avg("f_stat").alias("f_stat"), F.avg("pvalue").alias("pvalue"),
        F.floor(F.avg("n_groups")).alias("n_groups"), F.count("*").alias("n_blocks"))


def pairwise(df, value=config.ANOVA_VALUE, factors=config.ANOVA_FACTORS):
    """(factor, group1, group2, meandiff, se, q, n_groups, df_within): Tukey's statistics.

    One row per pair of factor levels, which is what the comparison reports; the pairs come from
    the group table, never from rows. meandiff is group2 − group1.
    """
    stats = group_stats(df, value, factors)
    left = stats.select("factor", F.col("level").alias("group1"), F.col("n").alias("n1"), F.col("mean").alias("mean1"))
    right = stats.select("factor", F.col("level").alias("group2"), F.col("n").alias("n2"), F.col("mean").alias("mean2"))
    pooled = one_way(stats).select("factor", "n_groups", "df_within", "ms_within", "df_between", "f_stat")
    se = F.sqrt(F.col("ms_within") / 2 * (1 / F.col("n1") + 1 / F.col("n2")))
    # Numeric levels are ordered as numbers.
    numeric = F.col("group1").try_cast("double") < F.col("group2").try_cast("double")
    ordered = F.coalesce(numeric, F.col("group1") < F.col("group2"))
    return (left.join(right, "factor").where(ordered).join(pooled, "factor")
            .withColumn("meandiff", F.col("mean2") - F.col("mean1")).withColumn("se", se)
            .withColumn("q", F.abs("meandiff") / F.nullif(F.col("se"), F.lit(0.0))))


def tukey(df, value=config.ANOVA_VALUE, factors=config.ANOVA_FACTORS, alpha=config.ALPHA, only_if=None):
    """Tukey HSD of the factors whose F test is significant (at ``only_if``, default alpha).

    (factor, group1, group2, meandiff, p_adj, lower, upper, reject)
    """
    pairs = with_anova_p(pairwise(df, value, factors)).where(
        F.col("pvalue") <= (alpha if only_if is None else only_if))
    # The critical value is a factor's: one search for each, not for each pair.
    factors = pairs.select("factor", "n_groups", "df_within").distinct().withColumn(
        "_critical", tails.studentized_range_quantile(F.lit(1 - alpha), "n_groups", "df_within")).select("factor", "_critical")
    judged = pairs.withColumn("p_adj", tails.studentized_range_tail("q", "n_groups", "df_within")).join(factors, "factor")
    reach = F.col("_critical") * F.col("se")
    return judged.select(
        "factor", "group1", "group2", "meandiff", "p_adj", (F.col("meandiff") - reach).alias("lower"),
        (F.col("meandiff") + reach).alias("upper"), (F.col("p_adj") < alpha).alias("reject"))
