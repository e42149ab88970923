"""Ranks, correlation, association, analysis of variance and normality."""

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from basketlens import config
from basketlens.functions import shapiro
from basketlens.functions.normal import normal_cdf_sql, normal_quantile, normal_quantile_sql
from basketlens.operators import anova, association, correlation, normality, order_stats, skew
from basketlens.plans.catalog import query
from basketlens.plans.quality_queries import ALL, TOTAL_ORDER, rounded, union_sql
from basketlens.plans.sales_view import derived, oracle, staged, staged_derived, valid

NUMBERS = ["units", "discount_pct", "amount", "sku"]
DERIVED_NUMBERS = [*config.DERIVED_NUMERIC, "amount"]
PAIRS = [p for p in combinations_with_replacement(DERIVED_NUMBERS, 2) if p[0] != p[1]]
RANK_PAIRS = [("age", "amount"), ("recency_days", "purchase_freq"), ("gross_amount", "amount_per_unit"),
              ("units", "discount_pct")]


@query("average_rank", oracle("valid", union_sql([
    f"""SELECT '{c}' AS variable, {c} AS value, count(*) AS copies, round(avg(r), 1) AS mean_rank
FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS r FROM valid WHERE {c} IS NOT NULL) GROUP BY {c}"""
    for c in ("units", "amount", "discount_pct")])))
def average_rank(spark, d):
    return order_stats.average_ranks(staged(valid(spark, d), *config.MEASURES), ["units", "amount", "discount_pct"])


# ---- correlation ------------------------------------------------------------------------

@query("corr_matrix", oracle("valid", union_sql([
    f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS corr FROM valid"
    for a in NUMBERS for b in NUMBERS])))
def corr_matrix(spark, d):
    return rounded(correlation.correlation_matrix(valid(spark, d), NUMBERS), 6, "corr")


@query("corr_pairs", oracle("derived", union_sql([
    f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS corr, "
    f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM derived" for a, b in PAIRS])))
def corr_pairs(spark, d):
    return rounded(correlation.pearson_pairs(derived(spark, d), PAIRS), 6, "corr")


@query("corr_matrix_derived", oracle("derived", union_sql([
    f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS corr FROM derived"
    for a in config.DERIVED_NUMERIC for b in config.DERIVED_NUMERIC])))
def corr_matrix_derived(spark, d):
    return rounded(correlation.correlation_matrix(derived(spark, d), config.DERIVED_NUMERIC), 6, "corr")


# Tail probabilities as power series of the lower tail, whose terms are all positive: another expansion than the
# library's, and one that SQL can sum. A lower tail of 1 needs no terms.
SERIES = "(SELECT CAST(unnest(range(4000)) AS DOUBLE) AS i)"


def beta_series_sql(x, a, b):
    """Term i of the lower tail of a beta distribution at x."""
    return f"exp(lgamma({a} + {b} + i) - lgamma({a} + 1 + i) - lgamma({b}) + ({a} + i) * ln({x}) + {b} * ln(1 - {x}))"


def beta_tail_sql(frame, keys, columns, x, a, b, certain):
    """``pvalue`` = 1 - lower tail, and 0 where ``certain`` says that it is below 1e-100; one row for each of the frame's keys."""
    term = beta_series_sql(x, a, b)
    return f"""SELECT {", ".join(f"any_value({c}) AS {c}" for c in columns)},
  round(greatest(0, 1 - sum(CASE WHEN {certain} THEN CASE WHEN i = 0 THEN 1 ELSE 0 END ELSE {term} END)), 7) AS pvalue
FROM {frame}, {SERIES} GROUP BY {keys}"""


@query("corr_pvalues", oracle("derived", "c AS (" + union_sql([
    f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS r, "
    f"count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM derived" for a, b in PAIRS])
    + "), e AS (SELECT var1, var2, n, round(r, 6) AS corr, r * r AS x FROM c) "
    + beta_tail_sql("e", "var1, var2", ["var1", "var2", "corr", "n"], "x", "0.5::DOUBLE", "((n - 2) / 2.0::DOUBLE)", "n * x > 500")))
def corr_pvalues(spark, d):
    found = correlation.with_correlation_p(correlation.pearson_pairs(derived(spark, d), PAIRS))
    return rounded(rounded(found, 6, "corr"), 7, "pvalue")


def spearman_sql(a, b, extra=""):
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS r{i}"
                      for i, c in enumerate((a, b)))
    return (f"SELECT '{a}' AS var1, '{b}' AS var2{extra}, round(corr(r0, r1), 6) AS corr, count(*) AS n "
            f"FROM (SELECT {ranks} FROM derived WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")


@query("spearman_pairs", oracle("derived", union_sql([spearman_sql(a, b) for a, b in RANK_PAIRS])))
def spearman_pairs(spark, d):
    lines = staged_derived(spark, d, "units", "discount_pct", "amount", *config.DERIVED_NUMERIC)
    return rounded(correlation.spearman_pairs(lines, RANK_PAIRS), 6, "corr")


CORR_BLOCK_PAIRS = [("units", "amount"), ("discount_pct", "amount"), ("units", "discount_pct")]


def block_corr_sql(a, b):
    ranks = ", ".join(f"rank() OVER (PARTITION BY block ORDER BY {c}) + (count(*) OVER (PARTITION BY block, {c}) - 1) / "
                      f"2.0::DOUBLE AS r{i}" for i, c in enumerate((a, b)))
    return (f"SELECT block, '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS pearson, corr(r0, r1) AS spearman, count(*) AS n "
            f"FROM (SELECT *, {ranks} FROM b WHERE {a} IS NOT NULL AND {b} IS NOT NULL) GROUP BY block")


@query("corr_blocks", oracle("valid", f"""
b AS (SELECT *, (row_number() OVER (ORDER BY {TOTAL_ORDER}) - 1) // 5000 AS block FROM valid),
s AS ({union_sql([block_corr_sql(a, b) for a, b in CORR_BLOCK_PAIRS])})
SELECT var1, var2, round(avg(pearson), 6) AS pearson, round(avg(spearman), 6) AS spearman,
  CAST(sum(n) AS BIGINT) AS n, count(*) AS n_blocks FROM s GROUP BY var1, var2"""))
def corr_blocks(spark, d):
    blocked = skew.with_blocks(valid(spark, d), ALL, config.BLOCK_ROWS)
    return rounded(correlation.correlation_by_block(blocked, CORR_BLOCK_PAIRS), 6, "pearson", "spearman")


# None of these columns passes the normality test, which the statement takes as given.
AUTO = ["units", "discount_pct", "amount", "age"]


@query("corr_auto", oracle("derived", union_sql([
    spearman_sql(a, b, ", 'spearman' AS method") for a, b in combinations_with_replacement(AUTO, 2)])))
def corr_auto(spark, d):
    lines = staged(derived(spark, d, "age"), *AUTO)
    return rounded(correlation.correlations(lines, correlation.all_pairs(AUTO)), 6, "corr")


NUMERIC_DERIVED_PAIRS = config.DERIVED_PAIRS[:6]
GROUPED_DERIVED_PAIRS = config.DERIVED_PAIRS[6:]


@query("derived_pairs", oracle("derived", union_sql(
    [spearman_sql(a, b, ", 'spearman' AS method") for a, b in NUMERIC_DERIVED_PAIRS]
    + [f"SELECT '{a}', '{b}', 'boxplot', CAST(NULL AS DOUBLE), count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) "
       "FROM derived" for a, b in GROUPED_DERIVED_PAIRS])))
def derived_pairs(spark, d):
    return rounded(correlation.pair_analysis(staged_derived(spark, d, "amount", *config.DERIVED)), 6, "corr")


@query("regression_line", oracle("derived", union_sql([
    f"SELECT '{x}' AS var1, '{y}' AS var2, round(regr_slope({y}, {x}), 8) AS slope, "
    f"round(regr_intercept({y}, {x}), 4) AS intercept, round(min({x}) FILTER (WHERE {y} IS NOT NULL), 4) AS x_min, "
    f"round(max({x}) FILTER (WHERE {y} IS NOT NULL), 4) AS x_max, regr_count({y}, {x})::BIGINT AS n FROM derived"
    for x, y in NUMERIC_DERIVED_PAIRS])))
def regression_line(spark, d):
    lines = correlation.regression_lines(derived(spark, d), NUMERIC_DERIVED_PAIRS)
    return rounded(rounded(lines, 8, "slope"), 4, "intercept", "x_min", "x_max")


# ---- association ------------------------------------------------------------------------

ASSOCIATED = [*config.ASSOCIATION_PAIRS, ("status", "gender")]


@query("crosstab", oracle("valid", """
SELECT channel, store, count(*) AS n FROM valid WHERE channel IS NOT NULL AND store IS NOT NULL GROUP BY channel, store"""))
def crosstab(spark, d):
    return association.crosstab(valid(spark, d), "channel", "store")


@query("crosstab_pivot", oracle("valid", """
SELECT channel, count(*) FILTER (WHERE gender = 1) AS gender_1, count(*) FILTER (WHERE gender = 2) AS gender_2
FROM valid WHERE channel IS NOT NULL AND gender IS NOT NULL GROUP BY channel"""))
def crosstab_pivot(spark, d):
    wide = association.crosstab_pivot(valid(spark, d), "channel", "gender", config.GENDERS)
    return wide.toDF("channel", "gender_1", "gender_2")


def chi2_sql(a, b, table="derived", block=None):
    """Chi-square the long way: every cell of levels × levels, empty ones included."""
    g = f"{block}, " if block else ""
    u = f"USING ({block})" if block else "ON true"
    part = f"PARTITION BY {block}" if block else ""
    return f"""SELECT {g}'{a}' AS var1, '{b}' AS var2,
  CASE WHEN any_value(dof) = 0 THEN 0.0::DOUBLE
       ELSE sum(power(abs(o - e) - CASE WHEN dof = 1 THEN least(0.5::DOUBLE, abs(o - e)) ELSE 0 END, 2) / e) END AS chi2,
  any_value(dof) AS dof, any_value(total) AS n, any_value(smaller) AS smaller
FROM (
  SELECT {g}coalesce(x.n, 0) AS o, r.n * c.n / t.n::DOUBLE AS e, (t.r - 1) * (t.c - 1) AS dof, t.n AS total,
    least(t.r, t.c) - 1 AS smaller
  FROM (SELECT {g}{a} AS a, count(*) AS n FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL) r
  JOIN (SELECT {g}{b} AS b, count(*) AS n FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL) c {u}
  JOIN (SELECT {g}count(*) AS n, count(DISTINCT {a}) AS r, count(DISTINCT {b}) AS c
        FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL {f'GROUP BY {block}' if block else ''}) t {u}
  LEFT JOIN (SELECT {g}{a} AS a, {b} AS b, count(*) AS n FROM {table}
        WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL) x USING ({g}a, b))
{f'GROUP BY {block}' if block else ''}"""


@query("chi2_test", oracle("derived", "s AS (" + union_sql([chi2_sql(a, b) for a, b in ASSOCIATED])
                           + ") SELECT var1, var2, round(chi2, 4) AS chi2, dof, n FROM s"))
def chi2_test(spark, d):
    found = association.chi_square(derived(spark, d, "amount_segment", "is_weekend"), ASSOCIATED)
    return rounded(found, 4, "chi2").select("var1", "var2", "chi2", "dof", "n")


@query("chi2_pvalues", oracle("derived", "s AS (" + union_sql([chi2_sql(a, b) for a, b in ASSOCIATED]) + f""")
SELECT var1, var2, round(any_value(chi2), 4) AS chi2, any_value(dof) AS dof, any_value(n) AS n,
  round(any_value(sqrt(chi2 / n / nullif(smaller, 0))), 6) AS cramers_v,
  round(greatest(0, 1 - sum(CASE WHEN dof = 0 THEN 0 WHEN chi2 > 1000 + 3 * dof THEN CASE WHEN i = 0 THEN 1 ELSE 0 END
    ELSE exp((dof / 2.0::DOUBLE + i) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2.0::DOUBLE + 1 + i)) END)), 7) AS pvalue
FROM s, {SERIES} GROUP BY var1, var2"""))
def chi2_pvalues(spark, d):
    found = association.chi_square(derived(spark, d, "amount_segment", "is_weekend"), ASSOCIATED)
    found = association.with_chi_square_p(found).select("var1", "var2", "chi2", "dof", "n", "cramers_v", "pvalue")
    return rounded(rounded(rounded(found, 4, "chi2"), 6, "cramers_v"), 7, "pvalue")


@query("cramers_v", oracle("derived", "s AS (" + union_sql([chi2_sql(a, b) for a, b in ASSOCIATED])
                           + ") SELECT var1, var2, round(sqrt(chi2 / n / nullif(smaller, 0)), 6) AS cramers_v FROM s"))
def cramers_v(spark, d):
    found = association.chi_square(derived(spark, d, "amount_segment", "is_weekend"), ASSOCIATED)
    return rounded(found, 6, "cramers_v").select("var1", "var2", "cramers_v")


BLOCKED_SQL = f"b AS (SELECT *, (row_number() OVER (ORDER BY {TOTAL_ORDER}) - 1) // 5000 AS block FROM valid)"
BLOCK_PAIRS = [("channel", "store"), ("channel", "gender"), ("status", "gender")]


@query("chi2_blocks", oracle("valid", BLOCKED_SQL + ", s AS ("
                             + union_sql([chi2_sql(a, b, "b", "block") for a, b in BLOCK_PAIRS]) + """)
SELECT var1, var2, round(avg(chi2), 4) AS chi2, round(avg(dof), 4) AS dof,
  round(avg(sqrt(chi2 / n / nullif(smaller, 0))), 6) AS cramers_v, count(*) AS n_blocks FROM s GROUP BY var1, var2"""))
def chi2_blocks(spark, d):
    blocked = skew.with_blocks(valid(spark, d), ALL, config.BLOCK_ROWS)
    found = association.chi_square_by_block(blocked, BLOCK_PAIRS)
    return rounded(rounded(found, 4, "chi2", "dof"), 6, "cramers_v").drop("pvalue")


# ---- analysis of variance ---------------------------------------------------------------

def one_way_sql(table, block=""):
    """Sums of squares from the rows, one SELECT per factor."""
    g = f"{block}, " if block else ""
    part = f"PARTITION BY {block}" if block else ""
    return union_sql([f"""
SELECT {g}'{f}' AS factor, count(DISTINCT level) AS n_groups, count(*) AS n,
  sum(power(level_mean - grand, 2)) / nullif(count(DISTINCT level) - 1, 0) AS ms_between,
  sum(power(x - level_mean, 2)) / nullif(count(*) - count(DISTINCT level), 0) AS ms_within
FROM (SELECT {g}{f} AS level, amount AS x, avg(amount) OVER (PARTITION BY {g}{f}) AS level_mean,
        avg(amount) OVER ({part}) AS grand FROM {table} WHERE {f} IS NOT NULL AND amount IS NOT NULL)
{f'GROUP BY {block}' if block else ''}""" for f in config.ANOVA_FACTORS])


@query("anova_oneway", oracle("valid", f"s AS ({one_way_sql('valid')})" + """
SELECT factor, n_groups, n, n_groups - 1 AS df_between, n - n_groups AS df_within, round(ms_within, 0) AS ms_within,
  round(ms_between / ms_within, 6) AS f_stat FROM s"""))
def anova_oneway(spark, d):
    found = anova.anova(valid(spark, d))
    return rounded(rounded(found, 0, "ms_within"), 6, "f_stat")


# F is a quotient of beta variables: x = d1 F / (d2 + d1 F).
ANOVA_P_SQL = """e AS (SELECT factor, n_groups, n, n_groups - 1 AS df_between, n - n_groups AS df_within, ms_within,
  ms_between / ms_within AS f_stat FROM s), x AS (SELECT *, df_between * f_stat / (df_within + df_between * f_stat) AS x FROM e),
p AS (""" + beta_tail_sql("x", "factor", ["factor", "n_groups", "n", "df_between", "df_within", "ms_within", "f_stat"], "x",
                          "(df_between / 2.0::DOUBLE)", "(df_within / 2.0::DOUBLE)", "df_within * x > 1000 + 10 * df_between") + ")"


@query("anova_pvalues", oracle("valid", f"s AS ({one_way_sql('valid')}), {ANOVA_P_SQL}" + """
SELECT factor, n_groups, n, df_between, df_within, round(ms_within, 0) AS ms_within, round(f_stat, 6) AS f_stat, pvalue FROM p"""))
def anova_pvalues(spark, d):
    found = anova.with_anova_p(anova.anova(valid(spark, d)))
    return rounded(rounded(rounded(found, 0, "ms_within"), 6, "f_stat"), 7, "pvalue")


@query("anova_blocks", oracle("valid", BLOCKED_SQL + f", s AS ({one_way_sql('b', 'block')})" + """
SELECT factor, round(avg(ms_between / ms_within), 6) AS f_stat, CAST(floor(avg(n_groups)) AS BIGINT) AS n_groups,
  count(*) AS n_blocks FROM s WHERE n_groups >= 2 GROUP BY factor"""))
def anova_blocks(spark, d):
    blocked = skew.with_blocks(valid(spark, d), ALL, config.BLOCK_ROWS)
    return rounded(anova.anova_by_block(blocked), 6, "f_stat").drop("pvalue")


# Groups, and one row for each pair of them with Tukey's statistics.
TUKEY_SQL = "g AS (" + union_sql([
    f"SELECT '{f}' AS factor, CAST({f} AS VARCHAR) AS level, count(*) AS n, avg(amount) AS mean, var_pop(amount) * count(*) AS ss "
    f"FROM valid WHERE {f} IS NOT NULL AND amount IS NOT NULL GROUP BY {f}" for f in config.ANOVA_FACTORS]) + """),
w AS (SELECT factor, count(*) AS k, sum(n) - count(*) AS dof, sum(ss) / (sum(n) - count(*)) AS ms_within FROM g GROUP BY factor),
t AS (SELECT factor, a.level AS group1, b.level AS group2, b.mean - a.mean AS meandiff, k, dof,
    sqrt(ms_within / 2 * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n)) AS se
  FROM g a JOIN g b USING (factor) JOIN w USING (factor) WHERE a.level < b.level)"""


@query("tukey_hsd", oracle("valid", TUKEY_SQL + """
SELECT factor, group1, group2, round(meandiff, 4) AS meandiff, round(se, 4) AS se, round(abs(meandiff) / se, 6) AS q FROM t"""))
def tukey_hsd(spark, d):
    pairs = anova.pairwise(valid(spark, d)).select("factor", "group1", "group2", "meandiff", "se", "q")
    return rounded(rounded(pairs, 4, "meandiff", "se"), 6, "q")


def range_sql(q, frame, columns, keys):
    """(columns, cdf) of the studentized range at q, by equal steps over values and scales."""
    z, t = "(-8.5 + y.j * 17 / 200.0::DOUBLE)", "(-9 / sqrt(2 * dof) + v.j * 18 / sqrt(2 * dof) / 120.0::DOUBLE)"
    share = f"exp(dof * (ln(1 + {t}) - {t} - {t} * {t} / 2) - ln(1 + {t}))"
    return f"""SELECT {columns}, sum(share * k * inner_sum) / sum(share) AS cdf FROM (
  SELECT {columns}, k, v.j AS scale, any_value({share}) AS share, sum(17 / 200.0::DOUBLE * exp(-{z} * {z} / 2) / sqrt(2 * pi())
      * power(greatest(0, {normal_cdf_sql(z)} - ({normal_cdf_sql(f'({z} - {q} * (1 + {t}))')})), k - 1)) AS inner_sum
  FROM {frame}, (SELECT unnest(range(121)) AS j) v, (SELECT unnest(range(201)) AS j) y GROUP BY {columns}, k, v.j) GROUP BY {keys}"""


def secant_sql(steps):
    """q0 … with cdf(q) = 1 - alpha by secant steps, each a table of (factor, k, dof, q, cdf)."""
    tables = []
    for n, start in enumerate((3.0, 4.0)):
        tables.append(f"c{n} AS ({range_sql('q', f'(SELECT factor, k, dof, {start}::DOUBLE AS q FROM w)', 'factor, dof, q', 'factor, dof, q')})")
    for n in range(2, steps):
        before, last = f"c{n - 2}", f"c{n - 1}"
        q = (f"(SELECT factor, w.k, w.dof, CASE WHEN b.cdf = a.cdf THEN b.q ELSE b.q + ({1 - config.ALPHA}::DOUBLE - b.cdf) * (b.q - a.q) "
             f"/ (b.cdf - a.cdf) END AS q FROM {before} a JOIN {last} b USING (factor) JOIN w USING (factor))")
        tables.append(f"c{n} AS ({range_sql('q', q, 'factor, dof, q', 'factor, dof, q')})")
    return ", ".join(tables)


SECANTS = 9
TUKEY_P_SQL = f"""{TUKEY_SQL}, {secant_sql(SECANTS)}, l AS (SELECT *, abs(meandiff) / se AS q FROM t),
u AS ({range_sql('q', 'l', 'factor, group1, group2, meandiff, se, dof, q', 'ALL')}),
tukey AS (SELECT u.factor, group1, group2, round(meandiff, 4) AS meandiff, round(1 - u.cdf, 6) AS p_adj,
  round(meandiff - c.q * se, 4) AS lower, round(meandiff + c.q * se, 4) AS upper, 1 - u.cdf < {config.ALPHA} AS reject
  FROM u JOIN c{SECANTS - 1} c ON u.factor = c.factor)"""


def tukey_rows(found):
    return rounded(rounded(found, 4, "meandiff", "lower", "upper"), 6, "p_adj")


@query("tukey_pvalues", oracle("valid", f"{TUKEY_P_SQL} SELECT * FROM tukey"))
def tukey_pvalues(spark, d):
    """The comparison for every factor, whatever its F test says."""
    return tukey_rows(anova.tukey(valid(spark, d), only_if=1.0))


@query("tukey_gated", oracle("valid", f"""{TUKEY_P_SQL}, s AS ({one_way_sql('valid')}), {ANOVA_P_SQL}
SELECT tukey.* FROM tukey JOIN p USING (factor) WHERE pvalue <= {config.ALPHA}"""))
def tukey_gated(spark, d):
    """The comparison for the factors whose F test is significant."""
    return tukey_rows(anova.tukey(valid(spark, d)))


# ---- normality --------------------------------------------------------------------------

def shapiro_sql(table, columns):
    """Royston's W the long way: a weight for each value of each block's column. ``judged`` holds a row for each."""
    key = "md5(concat_ws('|', " + ", ".join(f"CAST(floor({c} * 1000) AS BIGINT)" for c in columns) + "))"
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    poly = (lambda coefficients, x: shapiro_polynomial(coefficients, x))
    u, ln_n = "(1 / sqrt(n))", "ln(n)"
    return f"""hashed AS (SELECT *, {key} AS key FROM {table}),
dealt AS (SELECT *, (row_number() OVER (ORDER BY key, {order}) - 1) // {config.BLOCK_ROWS} AS block FROM hashed),
long AS ({union_sql([f"SELECT block, '{c}' AS variable, CAST({c} AS DOUBLE) AS v FROM dealt WHERE {c} IS NOT NULL" for c in columns])}),
r AS (SELECT *, row_number() OVER (PARTITION BY block, variable ORDER BY v) AS i, CAST(count(*) OVER (PARTITION BY block, variable) AS DOUBLE) AS n,
  v - avg(v) OVER (PARTITION BY block, variable) AS x, stddev_pop(v) OVER (PARTITION BY block, variable) AS sd FROM long),
m AS (SELECT *, {normal_quantile_sql('((i - 0.375) / (n + 0.25))')} AS m, {normal_quantile_sql('((n - 0.375) / (n + 0.25))')} AS m1,
  {normal_quantile_sql('((n - 1.375) / (n + 0.25))')} AS m2 FROM r),
a1 AS (SELECT *, sum(m * m) OVER (PARTITION BY block, variable) AS mm FROM m),
a2 AS (SELECT *, {poly(shapiro.WEIGHT_LAST, u)} + m1 / sqrt(mm) AS w1, {poly(shapiro.WEIGHT_NEXT, u)} + m2 / sqrt(mm) AS w2 FROM a1),
a3 AS (SELECT *, CASE WHEN i = n THEN w1 WHEN i = 1 THEN -w1 WHEN i = n - 1 THEN w2 WHEN i = 2 THEN -w2
  ELSE m / sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * w1 * w1 - 2 * w2 * w2)) END AS a FROM a2),
s AS (SELECT variable, block, CAST(any_value(n) AS BIGINT) AS n, power(sum(a * x), 2) / sum(x * x) AS w,
  max(greatest(i / n - ({normal_cdf_sql('(x / sd)')}), ({normal_cdf_sql('(x / sd)')}) - (i - 1) / n)) AS d FROM a3 GROUP BY variable, block),
z AS (SELECT *, (ln(1 - w) - ({poly(shapiro.LARGE_MEAN, ln_n)})) / exp({poly(shapiro.LARGE_LOG_SD, ln_n)}) AS z,
  d * sqrt(n) + 1 / (6 * sqrt(n)) + (d * sqrt(n) - 1) / (4 * n) AS kz FROM s),
judged AS (SELECT variable, block, n, w, 1 - ({normal_cdf_sql('z')}) AS shapiro_p, d, {kolmogorov_sql('kz')} AS ks_p FROM z)"""


def shapiro_polynomial(coefficients, x):
    text = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        text = f"({text} * {x} + ({c!r}::DOUBLE))"
    return text


def kolmogorov_sql(z):
    """The alternating series, with as many terms as small arguments need."""
    return (f"least(1, greatest(0, CASE WHEN {z} < 0.15 THEN 1 ELSE 2 * list_sum([(1 - 2 * ((j - 1) % 2)) * exp(-2 * j * j * {z} * {z}) "
            "FOR j IN range(1, 120)]) END))")


@query("shapiro_blocks", oracle("valid", shapiro_sql("valid", config.MEASURES) + """
SELECT variable, block, n, round(w, 7) AS shapiro_stat, round(shapiro_p, 7) AS shapiro_p FROM judged"""))
def shapiro_blocks(spark, d):
    found = normality.normality_blocks(valid(spark, d), config.MEASURES).select(
        "variable", "block", "n", "shapiro_stat", "shapiro_p")
    return rounded(found, 7, "shapiro_stat", "shapiro_p")


KS_SQL = "f AS (" + union_sql([
    f"SELECT '{c}' AS variable, {c} AS x, count(*) OVER () AS n, avg({c}) OVER () AS mean, stddev_pop({c}) OVER () AS sd "
    f"FROM valid WHERE {c} IS NOT NULL" for c in config.MEASURES]) + f"""),
d AS (SELECT variable, x, any_value(n) AS n, any_value((x - mean) / sd) AS z, count(*) AS copies FROM f GROUP BY variable, x),
r AS (SELECT *, sum(copies) OVER (PARTITION BY variable ORDER BY x) - copies AS before FROM d),
g AS (SELECT variable, n, before, copies, {normal_cdf_sql('z')} AS cdf FROM r)"""


@query("ks_normal", oracle("valid", KS_SQL + """ SELECT variable, any_value(n) AS n,
  round(max(greatest(cdf - before / n::DOUBLE, (before + copies) / n::DOUBLE - cdf)), 6) AS ks_stat FROM g GROUP BY variable"""))
def ks_normal(spark, d):
    found = normality.ks_normal(staged(valid(spark, d), *config.MEASURES), config.MEASURES)
    return rounded(found, 6, "ks_stat").drop("ks_p")


@query("ks_normal_pvalues", oracle("valid", KS_SQL + f""", k AS (SELECT variable, any_value(n) AS n,
  max(greatest(cdf - before / n::DOUBLE, (before + copies) / n::DOUBLE - cdf)) AS d FROM g GROUP BY variable),
z AS (SELECT *, d * sqrt(n) + 1 / (6 * sqrt(n)) + (d * sqrt(n) - 1) / (4 * n) AS z FROM k)
SELECT variable, n, round(d, 6) AS ks_stat, round({kolmogorov_sql('z')}, 7) AS ks_p FROM z"""))
def ks_normal_pvalues(spark, d):
    found = normality.ks_normal(staged(valid(spark, d), *config.MEASURES), config.MEASURES)
    return rounded(rounded(found, 6, "ks_stat"), 7, "ks_p")


# Two columns that are normal by construction, from a number of the row, so that a pair takes Pearson's branch.
NORMAL_SQL = [("n1", "((receipt_id * 7919 + line_no * 104729) % 9973 + 0.5::DOUBLE) / 9973"),
              ("n2", "((receipt_id * 611953 + line_no * 7727) % 9967 + 0.5::DOUBLE) / 9967")]
MIXED = ["n1", "n2", "amount"]


@query("corr_auto_normal", oracle("valid", "derived AS (SELECT amount, " + ", ".join(
    f"{normal_quantile_sql(f'({u})')} AS {n}" for n, u in NORMAL_SQL) + """ FROM valid)
SELECT 'n1' AS var1, 'n2' AS var2, 'pearson' AS method, round(corr(n1, n2), 6) AS corr, count(*) AS n FROM derived
UNION ALL """ + union_sql([spearman_sql(a, "amount", ", 'spearman' AS method") for a in ("n1", "n2")])))
def corr_auto_normal(spark, d):
    lines = valid(spark, d)
    normals = [normal_quantile((F.pmod(F.col("receipt_id") * a + F.col("line_no") * b, F.lit(m)) + 0.5) / m).alias(n)
               for n, a, b, m in (("n1", 7919, 104729, 9973), ("n2", 611953, 7727, 9967))]
    pairs = [("n1", "n2"), ("n1", "amount"), ("n2", "amount")]
    return rounded(correlation.correlations(staged(lines.select("amount", *normals)), pairs), 6, "corr")


NORMALS = [*config.MEASURES, *config.DERIVED_NUMERIC]


@query("normality_verdict", oracle("derived", shapiro_sql("derived", NORMALS) + f"""
SELECT variable, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_blocks, round(avg(w), 7) AS shapiro_stat, round(avg(shapiro_p), 7) AS shapiro_p,
  round(avg(d), 6) AS ks_stat, round(avg(ks_p), 7) AS ks_p,
  CASE WHEN avg(shapiro_p) > {config.ALPHA} AND avg(ks_p) > {config.ALPHA} THEN '{config.NORMAL_NOT_REJECTED}'
       ELSE '{config.NORMAL_REJECTED}' END AS verdict FROM judged GROUP BY variable"""))
def normality_verdict(spark, d):
    judged = normality.verdict(normality.normality_table(derived(spark, d), NORMALS))
    return rounded(rounded(judged, 7, "shapiro_stat", "shapiro_p", "ks_p"), 6, "ks_stat")
