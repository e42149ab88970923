"""Plot-ready tables."""

from pyspark.sql import functions as F

from basketlens import config
from basketlens.functions.normal import normal_quantile_sql
from basketlens.operators import plotdata
from basketlens.plans.catalog import query
from basketlens.plans.quality_queries import rounded, union_sql
from basketlens.plans.sales_view import derived, oracle, staged, valid

HISTOGRAMS = [*config.MEASURES, *config.DERIVED_NUMERIC]


@query("histogram", oracle("derived", "h AS (" + union_sql([f"""
SELECT '{c}' AS variable, l.low, l.width, b.bin, count(v.{c}) AS n
FROM (SELECT min({c}) AS low, (max({c}) - min({c})) / 30 AS width FROM derived) l
CROSS JOIN (SELECT unnest(range(30)) AS bin) b
LEFT JOIN derived v ON least(floor((v.{c} - l.low) / l.width)::BIGINT, 29) = b.bin
GROUP BY ALL""" for c in HISTOGRAMS]) + """)
SELECT variable, bin, round(low + bin * width, 6) AS lower, round(low + (bin + 1) * width, 6) AS upper, n FROM h"""))
def histogram(spark, d):
    return rounded(plotdata.histogram(staged(derived(spark, d), *HISTOGRAMS), HISTOGRAMS), 6, "lower", "upper")


DENSITIES = ["units", "discount_pct", "amount", "age", "hour", "purchase_freq", "recency_days"]


@query("kde_grid", oracle("derived", union_sql([f"""
SELECT '{c}' AS variable, point, round(any_value(x), 4) AS x,
  round(sum(w * exp(-power((x - value) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM (SELECT g.point, l.low + g.point * (l.high - l.low) / 199 AS x, v.value, v.w, l.n,
        l.sd * power(l.n, -0.2::DOUBLE) AS h
      FROM (SELECT {c} AS value, count(*) AS w FROM derived WHERE {c} IS NOT NULL GROUP BY {c}) v
      CROSS JOIN (SELECT unnest(range(200)) AS point) g
      CROSS JOIN (SELECT min({c}) AS low, max({c}) AS high, stddev_samp({c}) AS sd, count({c}) AS n FROM derived) l)
GROUP BY point""" for c in DENSITIES])))
def kde_grid(spark, d):
    return rounded(rounded(plotdata.density(staged(derived(spark, d), *DENSITIES), DENSITIES), 4, "x"), 6, "density")


QQ = config.MEASURES


@query("qq_points", oracle("valid", union_sql([f"""
SELECT '{c}' AS variable, round(value, 4) AS value, copies, rank_first, rank_last, n,
  round(CASE WHEN rank_first = 1 THEN 1 - power(0.5::DOUBLE, 1.0::DOUBLE / n)
             WHEN rank_first = n THEN power(0.5::DOUBLE, 1.0::DOUBLE / n)
             ELSE (rank_first - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END, 6) AS position_first,
  round(CASE WHEN rank_last = 1 THEN 1 - power(0.5::DOUBLE, 1.0::DOUBLE / n)
             WHEN rank_last = n THEN power(0.5::DOUBLE, 1.0::DOUBLE / n)
             ELSE (rank_last - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END, 6) AS position_last
FROM (SELECT {c} AS value, count(*) AS copies, min(r) AS rank_first, max(r) AS rank_last, any_value(n) AS n
      FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM valid WHERE {c} IS NOT NULL)
      GROUP BY {c})""" for c in QQ])))
def qq_points(spark, d):
    points = rounded(plotdata.qq_points(staged(valid(spark, d), *QQ), QQ), 4, "value")
    return rounded(points, 6, "position_first", "position_last")


POSITION = """CASE WHEN {r} = 1 THEN 1 - power(0.5::DOUBLE, 1.0::DOUBLE / n)
  WHEN {r} = n THEN power(0.5::DOUBLE, 1.0::DOUBLE / n) ELSE ({r} - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END"""


@query("qq_quantiles", oracle("valid", "p AS (" + union_sql([f"""
SELECT '{c}' AS variable, {c} AS value, count(*) AS copies, min(r) AS rank_first, max(r) AS rank_last, any_value(n) AS n
FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM valid WHERE {c} IS NOT NULL)
GROUP BY {c}""" for c in QQ]) + f"""),
q AS (SELECT *, {POSITION.format(r='rank_first')} AS p1, {POSITION.format(r='rank_last')} AS p2 FROM p)
SELECT variable, round(value, 4) AS value, copies, rank_first, rank_last, n, round({normal_quantile_sql('p1')}, 8) AS quantile_first,
  round({normal_quantile_sql('p2')}, 8) AS quantile_last FROM q"""))
def qq_quantiles(spark, d):
    points = plotdata.with_normal_quantiles(plotdata.qq_points(staged(valid(spark, d), *QQ), QQ))
    return rounded(rounded(points, 4, "value"), 8, "quantile_first", "quantile_last").drop("position_first", "position_last")


QQ_COLUMNS = [*config.MEASURES, *config.DERIVED_NUMERIC]


@query("qq_fit", oracle("derived", "r AS (" + union_sql([
    f"SELECT '{c}' AS variable, {c} AS value, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM derived "
    f"WHERE {c} IS NOT NULL" for c in QQ_COLUMNS]) + f"""),
p AS (SELECT *, {POSITION.format(r='r')} AS p FROM r), q AS (SELECT variable, value, n, {normal_quantile_sql('p')} AS q FROM p)
SELECT variable, any_value(n) AS n, CAST(CAST(regr_slope(value, q) AS FLOAT) AS DOUBLE) AS slope,
  CAST(CAST(regr_intercept(value, q) AS FLOAT) AS DOUBLE) AS intercept, round(corr(q, value), 8) AS r FROM q GROUP BY variable"""))
def qq_fit(spark, d):
    found = rounded(plotdata.qq_fit(staged(derived(spark, d), *QQ_COLUMNS), QQ_COLUMNS), 8, "r")
    return found.withColumns({c: F.col(c).cast("float").cast("double") for c in ("slope", "intercept")})


BOXES = [("amount", "channel"), ("amount", "store"), ("amount_per_unit", "is_weekend"), ("amount", "is_weekend"),
         ("amount_per_unit", "amount_segment"), ("gross_amount", "amount_segment"), ("amount", "amount_segment")]


@query("box_stats", oracle("derived", "s AS (" + union_sql([f"""
SELECT '{v}' AS value_column, '{g}' AS group_column, CAST({g} AS VARCHAR) AS level, {v} AS x,
  quantile_cont({v}, 0.25) OVER (PARTITION BY {g}) AS q1, quantile_cont({v}, 0.5) OVER (PARTITION BY {g}) AS median,
  quantile_cont({v}, 0.75) OVER (PARTITION BY {g}) AS q3 FROM derived WHERE {g} IS NOT NULL AND {v} IS NOT NULL"""
                                                            for v, g in BOXES]) + """)
SELECT value_column, group_column, level, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
  round(any_value(q3), 6) AS q3,
  round(min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(x) FILTER (WHERE x <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
FROM s GROUP BY value_column, group_column, level"""))
def box_stats(spark, d):
    lines = staged(derived(spark, d, "amount_per_unit", "gross_amount", "amount_segment", "is_weekend"), "amount",
                   "amount_per_unit", "gross_amount", "channel", "store", "amount_segment", "is_weekend")
    return rounded(plotdata.box_stats(lines, BOXES), 6, "q1", "median", "q3", "whisker_low", "whisker_high")


def place_sql(c, low, high, bins):
    return f"least(floor(({c} - {low}) / ({high} - {low}) * {bins})::BIGINT, {bins - 1})"


def grid_sql(x, y, table, bins, by=""):
    g = f"{by}, " if by else ""
    return f"""
SELECT {g}{place_sql('x', 'x0', 'x1', bins)} AS bin_x, {place_sql('y', 'y0', 'y1', bins)} AS bin_y, count(*) AS n
FROM (SELECT {g}{x}::DOUBLE AS x, {y}::DOUBLE AS y, min({x}::DOUBLE) OVER () AS x0, max({x}::DOUBLE) OVER () AS x1,
        min({y}::DOUBLE) OVER () AS y0, max({y}::DOUBLE) OVER () AS y1
      FROM {table} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) GROUP BY ALL"""


@query("scatter_bins", oracle("derived", grid_sql("age", "amount", "derived", 50)))
def scatter_bins(spark, d):
    return plotdata.scatter_bins(derived(spark, d, "age"), "age", "amount")


@query("regression_points", oracle("derived", """
l AS (SELECT regr_slope(amount, gross_amount) AS slope, regr_intercept(amount, gross_amount) AS intercept,
        min(gross_amount) AS x_min, max(gross_amount) AS x_max FROM derived
      WHERE amount IS NOT NULL AND gross_amount IS NOT NULL),
p AS (SELECT unnest(range(100)) AS point)
SELECT 'gross_amount' AS var1, 'amount' AS var2, point, round(x_min + point * ((x_max - x_min) / 99), 4) AS x,
  round(slope * (x_min + point * ((x_max - x_min) / 99)) + intercept, 4) AS y FROM l CROSS JOIN p"""))
def regression_points(spark, d):
    lines = plotdata.regression_lines(derived(spark, d, "gross_amount"), [("gross_amount", "amount")])
    points = plotdata.line_points(lines).withColumn("point", F.col("point").cast("bigint"))
    return rounded(points, 4, "x", "y")
