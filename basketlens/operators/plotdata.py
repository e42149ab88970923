"""The numbers behind the plots: histograms, densities, QQ points, boxes, binned scatters."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from basketlens import config
from basketlens.config import present
from basketlens.functions.normal import normal_quantile, normal_quantile_array
from basketlens.functions.columns import number
from basketlens.operators import order_stats
from basketlens.operators.describe import per_column
from basketlens.operators.order_stats import long_values
from basketlens.operators.skew import attach_by_key

RANK_CHUNK = 1_000
RANKS_AT_ONCE = 1 << 18
CELL = 0.5  # width of a cell in bandwidths
MOMENTS = 12
KERNEL_REACH = 9.0  # bandwidths; beyond, a kernel is below 1e-17


def histogram(df, columns, bins=config.HISTOGRAM_BINS):
    """(variable, bin, lower, upper, n) of equal-width bins from min to max, the last one closed.

    Empty bins are included. A constant column gets a range of one around its value.
    """
    columns = present(df, columns)
    limits = per_column(df, columns, low=F.min, high=F.max).where("low IS NOT NULL")
    constant = F.col("low") == F.col("high")
    limits = limits.select(
        "variable", F.when(constant, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        (F.when(constant, F.lit(1.0)).otherwise(F.col("high") - F.col("low")) / bins).alias("width"))
    # One row per requested column.
    limits = F.broadcast(limits)
    place = F.least(F.floor((F.col("value") - F.col("low")) / F.col("width")), F.lit(bins - 1))
    counts = (long_values(df, columns).join(limits, "variable")
              .groupBy("variable", place.alias("bin")).agg(F.count("*").alias("n")))
    frame = limits.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"))
    return frame.join(counts, ["variable", "bin"], "left").select(
        "variable", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("lower"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"))


def density(df, columns, points=config.DENSITY_POINTS):
    """(variable, point, x, density): Gaussian kernel density with Scott's bandwidth h.

    The values are counted into cells of half a bandwidth, each with its moments: sums of powers s**k / k! of the values' places s
    (in bandwidths from the cell's middle, a quarter at most). As exp(-(t - s)**2 / 2) is the sum of s**k / k! · He_k(t) · exp(-t**2 / 2) with
    Hermite's polynomials, a cell adds to a grid point the sum of its moments times He_k: with ``MOMENTS`` terms the remainder is
    below 1e-11 for each value. One pass over the rows, combined on the map side; the cells' number depends on the range in bandwidths.
    """
    columns = present(df, columns)
    fitted = per_column(df, columns, n=F.count, sd=F.stddev_samp, low=F.min, high=F.max).where("n > 1 AND sd > 0")
    # One row per requested column.
    fitted = F.broadcast(fitted.withColumn("h", F.col("sd") * F.pow("n", F.lit(-0.2)))
                         .withColumn("step", (F.col("high") - F.col("low")) / (points - 1)))
    placed = (long_values(df, columns).join(fitted, "variable")
              .withColumn("cell", F.floor((F.col("value") - F.col("low")) / F.col("h") / CELL))
              .withColumn("s", (F.col("value") - F.col("low")) / F.col("h") - (F.col("cell") + 0.5) * CELL))
    power, sums = F.lit(1.0), []
    for k in range(MOMENTS):
        sums.append(F.sum(power).alias(f"m{k}"))
        power = power * F.col("s") / (k + 1)
    cells = placed.groupBy("variable", "cell", "n", "h", "low", "step").agg(*sums)
    grid = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")).withColumn(
        "t", F.col("point") * F.col("step") / F.col("h") - (F.col("cell") + 0.5) * CELL).where(F.abs("t") < KERNEL_REACH)
    hermite, kernels = F.lit(1.0), F.lit(0.0)
    for k in range(MOMENTS):
        name = f"e{k}"
        grid = grid.withColumn(name, hermite)
        kernels = kernels + F.col(f"m{k}") * F.col(name)
        hermite = F.col("t") * F.col(name) - k * (F.col(f"e{k - 1}") if k else F.lit(0.0))
    summed = grid.groupBy("variable", "point", "n", "h", "low", "step").agg(F.sum(kernels * F.exp(-F.col("t") * F.col("t") / 2)).alias("kernels"))
    every = fitted.select("variable", "n", "h", "low", "step", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    found = every.join(summed.select("variable", "point", "kernels"), ["variable", "point"], "left")
    point = F.col("point").cast("bigint")
    return found.select("variable", point.alias("point"), (F.col("low") + point * F.col("step")).alias("x"),
                        (F.coalesce("kernels", F.lit(0.0)) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))


def qq_points(df, columns):
    """(variable, value, copies, rank_first, rank_last, n, position_first, position_last).

    The order statistics, one row per run of equal values, with Filliben's plotting positions of
    the run's first and last rank.
    """
    ranks = order_stats.value_ranks(df, present(df, columns))
    sizes = per_column(df, present(df, columns), n=F.count)
    runs = ranks.join(F.broadcast(sizes), "variable").select(
        "variable", "value", "copies", (F.col("before") + 1).alias("rank_first"),
        (F.col("before") + F.col("copies")).alias("rank_last"), "n")
    return runs.withColumn("position_first", plotting_position("rank_first", "n")).withColumn(
        "position_last", plotting_position("rank_last", "n"))


def plotting_position(rank, n):
    last = F.pow(F.lit(0.5), 1 / F.col(n))
    return (F.when(F.col(rank) == 1, 1 - last).when(F.col(rank) == F.col(n), last)
            .otherwise((F.col(rank) - 0.3175) / (F.col(n) + 0.365)))


def with_normal_quantiles(points):
    """Add the theoretical quantiles of a run's first and last position."""
    return points.withColumn("quantile_first", normal_quantile("position_first")).withColumn(
        "quantile_last", normal_quantile("position_last"))


def _position_sums(batches):
    """(variable, n, centre and sums) of each batch of rows (variable, value, a, b, n, centre): the ranks from a to b have the value.

    Sums of the ranks' normal quantiles, their squares and products with the centred value, of the values and their squares.
    """
    for batch in batches:
        names, low, high = batch["variable"], batch["a"].to_numpy(), batch["b"].to_numpy()
        for name in names.unique().to_pylist():
            mine = np.flatnonzero(pc.equal(names, name).to_numpy(zero_copy_only=False))
            n, centre = batch["n"][int(mine[0])].as_py(), batch["centre"][int(mine[0])].as_py()
            v = batch["value"].to_numpy()[mine] - centre
            sizes = high[mine] - low[mine] + 1
            sums = np.zeros(5)
            # So many rows at once that their ranks stay a bounded array.
            at = np.cumsum(sizes) // RANKS_AT_ONCE
            for part in np.split(np.arange(len(mine)), np.flatnonzero(np.diff(at)) + 1):
                many, ends = sizes[part], np.cumsum(sizes[part])
                rank = np.arange(ends[-1]) + np.repeat(low[mine][part] - (ends - many), many)
                q, x = normal_quantile_array(positions(rank, n)), np.repeat(v[part], many)
                sums += [q.sum(), (q * q).sum(), (q * x).sum(), x.sum(), (x * x).sum()]
            yield pa.RecordBatch.from_pydict({"variable": [name], "n": [n], "centre": [centre],
                                              **{c: [float(s)] for c, s in zip(("sq", "sqq", "sqv", "sv", "svv"), sums)}})


def positions(rank, n):
    """``plotting_position`` of an array of ranks."""
    last = 0.5 ** (1 / n)
    return np.where(rank == 1, 1 - last, np.where(rank == n, last, (rank - 0.3175) / (n + 0.365)))


def qq_fit(df, columns, chunk=RANK_CHUNK):
    """(variable, n, slope, intercept, r): least squares of the values on the normal quantiles.

    The quantiles of a batch's ranks are taken as arrays and summed up in the task. A run of more than ``chunk`` equal values is cut
    into chunks of ranks that spread over all tasks, so a value that owns a third of the rows is not summed in one place; other
    runs are summed where they were ranked.
    """
    # The quantiles have mean zero; values are centred so that large amounts keep their digits.
    centres = F.broadcast(per_column(df, columns, centre=F.avg))
    runs = qq_points(df, columns).select("variable", "value", F.col("rank_first").alias("a"), F.col("rank_last").alias("b"), "n")
    step = F.lit(chunk).cast("bigint")
    size = F.col("b") - F.col("a") + 1
    cut = (runs.where(size > step).withColumn("end", F.col("b")).withColumn("a", F.explode(F.sequence("a", "b", step)))
           .withColumn("b", F.least(F.col("a") + step - 1, F.col("end"))).drop("end").repartition("variable", "a"))
    wanted = ["variable", "value", "a", "b", "n", "centre"]
    parts = [x.join(centres, "variable").select(*wanted).mapInArrow(
        _position_sums, "variable STRING, n BIGINT, centre DOUBLE, sq DOUBLE, sqq DOUBLE, sqv DOUBLE, sv DOUBLE, svv DOUBLE")
        for x in (runs.where(size <= step), cut)]
    summed = parts[0].unionAll(parts[1]).groupBy("variable", "n", "centre").agg(
        *[F.sum(c).alias(c) for c in ("sq", "sqq", "sqv", "sv", "svv")])
    n = F.col("n")
    cqq = F.col("sqq") - F.col("sq") * F.col("sq") / n
    cvv = F.col("svv") - F.col("sv") * F.col("sv") / n
    cqv = F.col("sqv") - F.col("sq") * F.col("sv") / n
    slope = cqv / F.nullif(cqq, F.lit(0.0))
    return summed.select("variable", "n", slope.alias("slope"),
                         (F.col("centre") + F.col("sv") / n - slope * F.col("sq") / n).alias("intercept"),
                         (cqv / F.nullif(F.sqrt(cqq * cvv), F.lit(0.0))).alias("r"))


def box_stats(df, pairs):
    """(value_column, group_column, level, n, q1, median, q3, whisker_low, whisker_high, outliers).

    Boxes of several (value, group) column pairs in one pass; levels as text. Whiskers end at the
    last value within 1.5 IQR of the box.
    """
    keys = ["value_column", "group_column", "level"]
    cells = F.array(*[F.struct(F.lit(v).alias("value_column"), F.lit(g).alias("group_column"),
                               F.col(g).cast("string").alias("level"), number(df, v).alias("value"))
                      for v, g in pairs])
    rows = (df.select(F.explode(cells).alias("c")).select("c.*")
            .where("level IS NOT NULL AND value IS NOT NULL").withColumn("variable", F.col("value_column")))
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    boxes = order_stats.widen(order_stats.group_quantiles(rows, list(names.values()), keys), names, [*keys, "n"])
    reach = (F.col("q3") - F.col("q1")) * config.IQR_FACTOR
    x = F.col("value")
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    box = [*keys, "n", "q1", "median", "q3"]
    ends = attach_by_key(rows, boxes.drop("variable"), keys, "n").groupBy(*box).agg(
        F.min(F.when(inside, x)).alias("low"), F.max(F.when(inside, x)).alias("high"),
        F.count_if(~inside).alias("outliers"))
    return ends.select(*box, F.least("low", "q1").alias("whisker_low"),
                       F.greatest("high", "q3").alias("whisker_high"), "outliers")


def scatter_bins(df, x, y, bins=50, by=()):
    """(by…, bin_x, bin_y, n): a scatter plot as counts on a grid over the data's range."""
    rows = df.select(*by, number(df, x).alias("x"), number(df, y).alias("y")).where(
        "x IS NOT NULL AND y IS NOT NULL")
    ends = rows.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()

    def place(c, low, high):
        if low is None or low == high:
            return F.lit(0).cast("bigint")
        return F.least(F.floor((F.col(c) - low) / (high - low) * bins), F.lit(bins - 1)).cast("bigint")

    return (rows.groupBy(*by, place("x", ends["x0"], ends["x1"]).alias("bin_x"),
                         place("y", ends["y0"], ends["y1"]).alias("bin_y")).agg(F.count("*").alias("n")))


def regression_lines(df, pairs):
    """(var1, var2, slope, intercept, x_min, x_max, n): least squares of var2 on var1, one pass."""
    names = sorted({c for pair in pairs for c in pair})
    df = df.select(*[number(df, c).alias(c) for c in names])
    fits = []
    for i, (x, y) in enumerate(pairs):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        seen = F.when(both, F.col(x))
        fits.append(F.struct(
            F.lit(x).alias("var1"), F.lit(y).alias("var2"), F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"), F.min(seen).alias("x_min"),
            F.max(seen).alias("x_max"), F.count_if(both).alias("n")).alias(f"p{i}"))
    one = df.agg(*fits)
    return one.select(F.explode(F.array(*one.columns)).alias("r")).select("r.*")


def line_points(lines, points=100):
    """(var1, var2, point, x, y) along each regression line."""
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    return (lines.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .withColumn("x", F.col("x_min") + F.col("point") * step)
            .select("var1", "var2", "point", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y")))
