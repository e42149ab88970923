"""Pearson and Spearman correlation over all pairs at once, and the analysis of column pairs."""

import math
from itertools import combinations_with_replacement

from pyspark.sql import Window, functions as F

from basketlens import config
from basketlens.functions import tails
from basketlens.functions.columns import number
from basketlens.operators import normality, order_stats, plotdata
from basketlens.operators.association import present_pairs
from basketlens.operators.quality import numeric_columns
from basketlens.operators.skew import attach_by_key, tasks_for
from basketlens.sources.staging import discard, materialize, temporary

LOOKUP_VALUES = 20_000  # different values of a column whose ranks are broadcast


def all_pairs(columns):
    """The upper triangle with the diagonal."""
    return list(combinations_with_replacement(columns, 2))


def _correlate(df, columns_of):
    """(var1, var2, corr, n) for {pair: (column, column)} in one aggregation.

    Rows that lack either value are skipped; a constant side has no correlation.
    """
    aggregates = []
    for i, (a, b) in enumerate(columns_of.values()):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
        varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
        # corr() itself fails on a constant side.
        spread = F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
        aggregates.append(F.struct(F.when(varies, F.covar_pop(x, y) / spread).alias("corr"),
                                   F.count_if(both).alias("n")).alias(f"p{i}"))
    one = df.agg(*aggregates)
    rows = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"p{i}.corr").alias("corr"),
                              F.col(f"p{i}.n").alias("n")) for i, (a, b) in enumerate(columns_of)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def pearson_pairs(df, pairs):
    pairs = present_pairs(df, pairs)
    names = sorted({c for pair in pairs for c in pair})
    return _correlate(df.select(*[number(df, c).alias(c) for c in names]), {p: p for p in pairs})


def spearman_pairs(df, pairs):
    """Pearson on average ranks, each pair ranked over the rows where both values are present.

    Ranks are counted from their mean, so they sum to zero and a pair's covariance is a sum of products. The ranks of a column with few
    different values are a small table that is broadcast to the rows. A column with many is met once: its values are counted,
    for each pair with the other side's ranks summed, and numbered in order, so its own ranks needn't go back to the rows. They do
    only for a partner that has many values too: rows and ranks are joined by the value. Each table is deleted when the next is written.
    """
    with temporary(df.sparkSession):
        return _spearman(df, pairs)


def _spearman(df, pairs):
    spark = df.sparkSession
    pairs = present_pairs(df, pairs)
    names = sorted({c for pair in pairs for c in pair})
    # Plain names of our own for columns and ranks.
    at = {c: f"c{i}" for i, c in enumerate(names)}
    rows = df.select(*[number(df, c).alias(at[c]) for c in names])
    edges = sorted({tuple(sorted((at[a], at[b]))) for a, b in pairs})
    given = {e: F.col(e[0]).isNotNull() & F.col(e[1]).isNotNull() for e in edges}
    one = rows.agg(*[F.count_if(given[e]).alias(f"n{i}") for i, e in enumerate(edges)],
                   *[F.approx_count_distinct(c).alias(c) for c in at.values()]).first()
    total = {e: one[f"n{i}"] for i, e in enumerate(edges)}
    of = {c: [i for i, e in enumerate(edges) if c in e] for c in at.values()}  # the column's pairs
    few = [c for c in at.values() if one[c] <= LOOKUP_VALUES]
    # Those with most partners first, so that few others' ranks go back to the rows.
    many = sorted((c for c in at.values() if c not in few), key=lambda c: (-len(of[c]), c))
    squares, products = {}, {}

    def other(c, i):
        a, b = edges[i]
        return b if a == c else a

    def ranked(c, counts):
        """The counts by value with the values' ranks r<pair>, and the sums of squares in them."""
        located = order_stats.running_totals(counts, c, [f"n{i}" for i in of[c]])
        return located.withColumns({f"r{i}": F.col(f"before_n{i}") + (F.col(f"n{i}") - total[edges[i]]) / 2 for i in of[c]})

    def squares_of(c):
        return [F.sum(F.col(f"n{i}") * F.col(f"r{i}") * F.col(f"r{i}")).alias(f"s{i}") for i in of[c]]

    def counted(c, *sums):
        present = [F.count_if(given[edges[i]]).alias(f"n{i}") for i in of[c]]
        return rows.where(F.col(c).isNotNull()).groupBy(c).agg(*present, *sums)

    def keep(c, found):
        squares.update({(c, i): found[f"s{i}"] for i in of[c]})

    done = set()
    for c in few:
        with temporary(spark) as only:
            table = only(materialize(ranked(c, counted(c))))
        keep(c, table.agg(*squares_of(c)).first())
        ranks = table.select(F.col(c).alias("_value"), *[F.col(f"r{i}").alias(f"{c}_{i}") for i in of[c]])
        # At most about LOOKUP_VALUES rows.
        rows = rows.join(F.broadcast(ranks), F.col(c) == F.col("_value"), "left").drop("_value")
        done.add(c)
    both = [i for i, e in enumerate(edges) if set(e) <= done]
    if both:
        sums = [F.sum(F.when(given[edges[i]], F.col(f"{edges[i][0]}_{i}") * F.col(f"{edges[i][1]}_{i}"))).alias(f"p{i}") for i in both]
        products.update(rows.agg(*sums).first().asDict())
    written = None  # the rows as written last
    for c in many:
        known = [i for i in of[c] if other(c, i) in done]
        later = [i for i in of[c] if other(c, i) not in done and other(c, i) != c]
        sums = [F.sum(F.when(given[edges[i]], F.col(f"{other(c, i)}_{i}"))).alias(f"t{i}") for i in known]
        with temporary(spark) as only:
            table = ranked(c, counted(c, *sums, F.count("*").alias("copies")))
            table = only(materialize(table)) if later else table
            found = table.agg(*squares_of(c), *[F.sum(F.col(f"t{i}") * F.col(f"r{i}")).alias(f"p{i}") for i in known]).first()
        keep(c, found)
        products.update({f"p{i}": found[f"p{i}"] for i in known})
        done.add(c)
        if later:
            ranks = table.select(c, "copies", *[F.col(f"r{i}").alias(f"{c}_{i}") for i in later])
            rest = [x for x in many if x not in done]
            # Of the rows only what the columns still to come need is moved and written.
            open_ = {x for r in rest for i in of[r] for x in [*edges[i], *[f"{q}_{i}" for q in edges[i]]]}
            with temporary(spark) as only:
                rows = attach_by_key(rows.select(*[x for x in rows.columns if x in open_ or x == c]), ranks, [c], "copies")
                rows = only(materialize(rows.select(*[x for x in rows.columns if x in open_]), compact=True))
            discard(table, *([written] if written else []))
            written = rows
    result = []
    for a, b in pairs:
        edge = tuple(sorted((at[a], at[b])))
        i = edges.index(edge)
        x, y = squares[edge[0], i], squares[edge[1], i]
        product = x if a == b else products[f"p{i}"]
        corr = product / math.sqrt(x) / math.sqrt(y) if x and y and product is not None else None
        result.append((a, b, corr, total[edge]))
    return df.sparkSession.createDataFrame(result, "var1 STRING, var2 STRING, corr DOUBLE, n BIGINT")


def correlation_by_block(blocked, pairs, block="block"):
    """(var1, var2, pearson, spearman, n, n_blocks): both coefficients per block, averaged.

    Blocks are bounded (see skew.with_blocks), so ranking one in a window is bounded too; so are the blocks that a task
    takes, as they are dealt to tasks by their number.
    """
    cells = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), number(blocked, a).alias("x"),
                               number(blocked, b).alias("y")) for a, b in present_pairs(blocked, pairs)])
    rows = (blocked.select(block, F.explode(cells).alias("c")).select(block, "c.*")
            .where("x IS NOT NULL AND y IS NOT NULL"))
    keys = [block, "var1", "var2"]
    tasks = tasks_for(blocked.sparkSession, blocked.count() * len(present_pairs(blocked, pairs)))
    rows = rows.repartition(tasks, *keys)
    ranked = rows.withColumns({f"rank_{c}": F.rank().over(Window.partitionBy(*keys).orderBy(c))
                               + (F.count("*").over(Window.partitionBy(*keys, c)) - 1) / 2 for c in ("x", "y")})

    def corr(x, y):
        spread = F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
        return F.covar_pop(x, y) / spread

    found = ranked.groupBy(*keys).agg(corr("x", "y").alias("pearson"), corr("rank_x", "rank_y").alias("spearman"),
                                      F.count("*").alias("n"))
    return found.groupBy("var1", "var2").agg(F.avg("pearson").alias("pearson"), F.avg("spearman").alias("spearman"),
                                             F.sum("n").alias("n"), F.count("*").alias("n_blocks"))


def correlation_matrix(df, columns, method="pearson"):
    """(var1, var2, corr) of the full symmetric matrix."""
    columns = [c for c in columns if c in df.columns]
    found = (pearson_pairs if method == "pearson" else spearman_pairs)(df, all_pairs(columns))
    return mirror(found.select("var1", "var2", "corr"))


def mirror(found):
    sides = F.array(F.struct("var1", "var2"), F.struct(F.col("var2").alias("var1"), F.col("var1").alias("var2")))
    return (found.select("corr", F.explode(F.array_distinct(sides)).alias("s"))
            .select("s.var1", "s.var2", "corr"))


def with_correlation_p(found):
    return found.withColumn("pvalue", tails.correlation_tail("corr", F.col("n").cast("double")))


def choose_method(df, columns, alpha=config.ALPHA):
    """The columns whose average Shapiro p passes alpha; one row per column reaches the driver."""
    table = normality.normality_table(df, columns)
    return {r["variable"] for r in table.collect() if r["shapiro_p"] is not None and r["shapiro_p"] > alpha}


def correlations(df, pairs=None, alpha=config.ALPHA):
    """(var1, var2, method, corr, n): Pearson where both columns look normal, else Spearman."""
    pairs = present_pairs(df, pairs or all_pairs(numeric_columns(df)))
    normal = choose_method(df, sorted({c for p in pairs for c in p}), alpha)
    tables = []
    for method, run, chosen in (
            ("pearson", pearson_pairs, [p for p in pairs if set(p) <= normal]),
            ("spearman", spearman_pairs, [p for p in pairs if not set(p) <= normal])):
        if chosen:
            name = F.when(F.col("corr").isNotNull(), method).otherwise("none")
            tables.append(run(df, chosen).select("var1", "var2", name.alias("method"), "corr", "n"))
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])


def pair_analysis(df, pairs=config.DERIVED_PAIRS, alpha=config.ALPHA):
    """(var1, var2, method, corr, n): correlation of two numbers, or a box summary's row count.

    A pair with a boolean or text side is compared by group (see plotdata.box_stats) and has no
    correlation.
    """
    pairs = present_pairs(df, pairs)
    numeric = set(numeric_columns(df))
    numbers = [p for p in pairs if set(p) <= numeric]
    grouped = [p for p in pairs if not set(p) <= numeric]
    found = None
    if numbers:
        found = correlations(df, numbers, alpha).withColumn(
            "method", F.when(F.col("method") == "none", "constant").otherwise(F.col("method")))
    if grouped:
        one = df.agg(*[F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"p{i}")
                       for i, (a, b) in enumerate(grouped)])
        rows = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.lit("boxplot").alias("method"),
                                  F.lit(None).cast("double").alias("corr"), F.col(f"p{i}").alias("n"))
                         for i, (a, b) in enumerate(grouped)])
        boxes = one.select(F.explode(rows).alias("r")).select("r.*")
        found = boxes if found is None else found.unionByName(boxes)
    return found


def regression_lines(df, pairs):
    """(var1, var2, slope, intercept, x_min, x_max, n): least squares of var2 on var1."""
    return plotdata.regression_lines(df, present_pairs(df, pairs))
