"""Exact quantiles, modes and ranks whose memory per task does not grow with the column.

Spark's ``percentile``, ``median`` and ``mode`` hold every distinct value of a group in one
buffer. Here rows are counted per value first, and only narrow slices are ever ordered.
"""

import math
from functools import reduce
from itertools import chain

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window, functions as F, types as T

from basketlens.functions.columns import INF, number
from basketlens.operators.skew import attach_by_key
from basketlens.sources.staging import materialize

ACCURACY = 10_000
GROUP_ACCURACY = 50_000
ENUMERATE_UP_TO = 1_000_000


def long_values(df, columns, by=()):
    """(by…, variable, value) with one row per non-null number."""
    wide = df.select(*by, *[number(df, c).alias(c) for c in columns if c not in by])
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("value")) for c in columns])
    return (wide.select(*by, F.explode(pairs).alias("_v"))
            .select(*by, "_v.variable", "_v.value").where("value IS NOT NULL"))


def quantiles(df, columns, probabilities, accuracy=ACCURACY, enumerate_up_to=ENUMERATE_UP_TO):
    """Exact interpolated quantiles of whole columns: (variable, probability, quantile, n)."""
    found = fit_quantiles(df, columns, probabilities, accuracy, enumerate_up_to)
    return df.sparkSession.createDataFrame([(c, float(p), value, n) for (c, p), (value, n) in found.items()],
                                           "variable STRING, probability DOUBLE, quantile DOUBLE, n BIGINT")


def fit_quantiles(df, columns, probabilities, accuracy=ACCURACY, enumerate_up_to=ENUMERATE_UP_TO):
    """{(column, probability): (exact quantile, n)}; columns without values are left out.

    A sketch brackets each quantile between two values. One pass of plain conditional counts
    says how many rows lie below and inside each bracket; brackets with many rows are narrowed
    by a further sketch of their rows only. What is left, at most ``enumerate_up_to`` rows or a
    single value per quantile, is counted per value and ordered. Each pass handles all columns,
    and only a fixed number of values per quantile reaches the driver.
    """
    wide = df.select(*[number(df, c).alias(c) for c in columns])
    targets = _sketch_all(wide, columns, [float(p) for p in probabilities], accuracy)
    _count(wide, targets)
    while True:
        # A bracket that no longer shrinks has its rows on the two end values, which the count
        # per value folds together.
        large = [t for t in targets if enumerate_up_to < t["inside"] < t.get("wider", math.inf) / 2
                 and t["low"] < t["high"]]
        if not large:
            break
        _narrow(wide, large, accuracy)
        _count(wide, large)
    values = _enumerate(wide, [t for t in targets if t["low"] < t["high"] and t["inside"]])
    return {(t["column"], t["p"]): (_interpolate(t, values), t["n"]) for t in targets}


def _sketch_all(wide, columns, probabilities, accuracy):
    slack = 2.0 / accuracy
    asked = F.array(*[F.lit(x) for p in probabilities for x in (max(p - slack, 0.0), min(p + slack, 1.0))])
    one = wide.agg(*[F.struct(F.percentile_approx(c, asked, accuracy).alias("ends"), F.count(c).alias("n")).alias(c)
                     for c in columns]).first()
    targets = []
    for c in columns:
        n = one[c]["n"]
        for i, p in enumerate(probabilities if n else []):
            place = (n - 1) * p
            targets.append({"column": c, "p": p, "n": n, "place": place, "first": math.floor(place),
                            "last": math.ceil(place), "low": one[c]["ends"][2 * i], "high": one[c]["ends"][2 * i + 1]})
    return targets


def _inside(t):
    return F.col(t["column"]).between(t["low"], t["high"])


def _count(wide, targets):
    """Rows below and inside each bracket, and the values next to it on either side."""
    if not targets:
        return
    one = wide.agg(*[F.struct(
        F.count_if(F.col(t["column"]) < t["low"]).alias("below"), F.count_if(_inside(t)).alias("inside"),
        F.max(F.when(F.col(t["column"]) < t["low"], F.col(t["column"]))).alias("previous"),
        F.min(F.when(F.col(t["column"]) > t["high"], F.col(t["column"]))).alias("following")).alias(f"t{i}")
        for i, t in enumerate(targets)]).first()
    for i, t in enumerate(targets):
        t |= one[f"t{i}"].asDict()
        if t["first"] < t["below"] - 1 or t["last"] > t["below"] + t["inside"]:
            raise RuntimeError(f"the quantile sketch of {t['column']} missed its bracket")


def _narrow(wide, targets, accuracy):
    slack = 2.0 / accuracy
    asked = []
    for i, t in enumerate(targets):
        low = max((t["first"] - t["below"]) / t["inside"] - slack, 0.0)
        high = min((t["last"] + 1 - t["below"]) / t["inside"] + slack, 1.0)
        ends = F.array(F.lit(low), F.lit(high))
        asked.append(F.percentile_approx(F.when(_inside(t), F.col(t["column"])), ends, accuracy).alias(f"t{i}"))
    one = wide.agg(*asked).first()
    for i, t in enumerate(targets):
        t["wider"] = t["inside"]
        t["low"], t["high"] = one[f"t{i}"]


def _enumerate(wide, targets):
    """{(target, rank): value} for the two ranks of each target, among the values inside."""
    if not targets:
        return {}
    wanted = reduce(lambda x, y: x | y, [_inside(t) for t in targets])
    options = F.array(*[F.when(_inside(t), F.struct(F.lit(i).alias("t"), F.col(t["column"]).alias("value")))
                        for i, t in enumerate(targets)])
    counts = (wide.where(wanted).select(F.explode(options).alias("o")).where("o IS NOT NULL")
              .groupBy("o.t", "o.value").agg(F.count("*").alias("w")))
    ranks = wide.sparkSession.createDataFrame(
        [(i, t["below"], rank) for i, t in enumerate(targets) for rank in {t["first"], t["last"]}],
        "t INT, below BIGINT, rank BIGINT")
    earlier = Window.partitionBy("t").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_before", F.coalesce(F.sum("w").over(earlier), F.lit(0)))
    at = F.col("rank") - F.col("below") - F.col("_before")
    picked = placed.join(F.broadcast(ranks), "t").where((at >= 0) & (at < F.col("w")))
    return {(targets[r["t"]]["column"], targets[r["t"]]["p"], r["rank"]): r["value"]
            for r in picked.select("t", "rank", "value").collect()}


def _interpolate(t, values):
    def value_at(rank):
        if rank < t["below"]:
            return t["previous"]
        if rank >= t["below"] + t["inside"]:
            return t["following"]
        return t["low"] if t["low"] == t["high"] else values[t["column"], t["p"], rank]

    a, b = value_at(t["first"]), value_at(t["last"])
    return a if a == b else a + (b - a) * (t["place"] - t["first"])


def group_quantiles(values, probabilities, by, accuracy=GROUP_ACCURACY):
    """Exact interpolated quantiles per group: (by…, variable, probability, quantile, n).

    ``values`` is (by…, variable, value); the groups may be many, so their brackets are a table
    that is joined to the rows. Rows outside a bracket are only counted, map side; the slice
    inside, about 4/accuracy of the group, is counted per value and ordered. If a sketch were
    ever too far off, the query fails rather than return a wrong value.
    """
    keys = [*by, "variable"]
    slack = 2.0 / accuracy
    lows = [max(p - slack, 0.0) for p in probabilities]
    highs = [min(p + slack, 1.0) for p in probabilities]
    sketch = F.percentile_approx("value", F.array(*[F.lit(p) for p in chain(lows, highs)]), accuracy)
    m = len(probabilities)
    brackets = values.groupBy(*keys).agg(sketch.alias("_e"), F.count("*").alias("n")).select(
        *keys, "n", F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.col("_e")[i].alias("low"),
                                       F.col("_e")[m + i].alias("high"))
                              for i, p in enumerate(probabilities)]).alias("_brackets"))
    bracketed = attach_by_key(values, brackets, keys, "n")
    zone = F.when(F.col("value") < F.col("_b.low"), -1).when(F.col("value") > F.col("_b.high"), 1).otherwise(0)
    slots = (bracketed.select(*keys, "n", "value", F.explode("_brackets").alias("_b"))
             .select(*keys, "n", "value", F.col("_b.probability").alias("probability"), zone.alias("zone"))
             .groupBy(*keys, "n", "probability", "zone", F.when(F.col("zone") == 0, F.col("value")).alias("v"))
             .agg(F.count("*").alias("w"), F.min("value").alias("least"), F.max("value").alias("most")))
    ordered = Window.partitionBy(*keys, "n", "probability").orderBy("zone", "v")
    upto = F.sum("w").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    slots = slots.withColumn("before", upto - F.col("w"))

    position = (F.col("n") - 1) * F.col("probability")

    def value_at(rank):
        inside = (rank >= F.col("before")) & (rank < F.col("before") + F.col("w"))
        usable = (F.when(F.col("zone") == 0, F.col("v"))
                  .when((F.col("zone") < 0) & (rank == F.col("before") + F.col("w") - 1), F.col("most"))
                  .when((F.col("zone") > 0) & (rank == F.col("before")), F.col("least"))
                  .otherwise(F.raise_error(F.lit("quantile sketch missed its bracket")).cast("double")))
        return F.max(F.when(inside, usable))

    found = slots.groupBy(*keys, "n", "probability").agg(
        value_at(F.floor(position)).alias("a"), value_at(F.ceil(position)).alias("b"))
    a, b = F.col("a"), F.col("b")
    between = F.when(a == b, a).otherwise(a + (b - a) * (position - F.floor(position)))
    return found.select(*keys, "probability", between.alias("quantile"), "n")


def quantiles_wide(df, columns, names):
    """One row per variable with a column per entry of ``names`` {name: probability}."""
    return widen(quantiles(df, columns, list(names.values())), names)


def widen(found, names, by=()):
    picked = [F.max(F.when(F.col("probability") == float(p), F.col("quantile"))).alias(name)
              for name, p in names.items()]
    return found.groupBy(*by, "variable").agg(*picked)


def quantiles_approx(df, columns, probabilities, accuracy=10_000):
    """Sketch quantiles (no interpolation) for all columns in one aggregation."""
    values = long_values(df, columns)
    ps = F.array(*[F.lit(float(p)) for p in probabilities])
    found = values.groupBy("variable").agg(F.percentile_approx("value", ps, accuracy).alias("q"))
    return found.select("variable", F.explode(F.arrays_zip(ps.alias("p"), F.col("q"))).alias("z")).select(
        "variable", F.col("z.p").alias("probability"), F.col("z.q").alias("quantile"))


def medians(df, columns, conditions=None):
    """{column: exact median}; ``conditions`` may restrict the rows used for a column."""
    if not columns:
        return {}
    conditions = conditions or {}
    masked = df.select(*[F.when(conditions.get(c, F.lit(True)), number(df, c)).alias(c) for c in columns])
    return {c: value for (c, _), (value, _) in fit_quantiles(masked, columns, [0.5]).items()}


def value_counts(df, columns):
    """(variable, value as text, n) for every column at once; nulls are kept as a value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.explode(pairs).alias("_v")).select("_v.variable", "_v.value")
            .groupBy("variable", "value").agg(F.count("*").alias("n")))


def numeric_modes(df, columns, keep_null=False):
    """(variable, mode, n): the most frequent number, the smallest one on ties.

    With ``keep_null`` a null that is more frequent than every number wins.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), number(df, c).alias("value")) for c in columns])
    counts = (df.select(F.explode(pairs).alias("_v")).select("_v.variable", "_v.value")
              .groupBy("variable", "value").agg(F.count("*").alias("n")))
    return _most_frequent(counts, keep_null)


def modes(df, columns):
    """(variable, mode as text, n) for any column type, nulls ignored, smallest on ties.

    Numbers are compared as numbers: 9.0 is smaller than 10.0.
    """
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    counts = value_counts(df, columns).where("value IS NOT NULL")
    size = F.when(F.col("variable").isin(numeric), F.col("value").try_cast("double"))
    first = F.min(F.struct((-F.col("n")).alias("less"), size.alias("size"), F.col("value")))
    return counts.groupBy("variable").agg(first.alias("f")).select(
        "variable", F.col("f.value").alias("mode"), (-F.col("f.less")).alias("n"))


def _most_frequent(counts, keep_null):
    if not keep_null:
        counts = counts.where("value IS NOT NULL")
    # A null sorts after every value of the same frequency.
    first = F.min(F.struct(-F.col("n"), F.col("value").isNull(), F.col("value")))
    return counts.groupBy("variable").agg(first.alias("f")).select(
        "variable", F.col("f.value").alias("mode"), (-F.col("f.col1")).alias("n"))


def value_ranks(df, columns, buckets=None):
    """(variable, value, copies, before): each distinct number with the rows ordered before it.

    Distinct values are spread over buckets cut at sketch quantiles (one driver action that
    returns ``buckets`` numbers per column) and numbered inside their bucket; the buckets'
    offsets are a running total over at most ``buckets`` rows per column. The cuts only balance
    the work and never change a rank.
    """
    spark = df.sparkSession
    buckets = buckets or max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    wide = df.select(*[number(df, c).alias(c) for c in columns])
    cuts = wide.approxQuantile(list(columns), [i / buckets for i in range(1, buckets)], 0.5 / buckets)
    splits = []
    for found in cuts:
        inner = sorted({x for x in found if -INF < x < INF})
        splits.append([-INF, *(inner or [0.0]), INF])
    places = [f"_bucket_{i}" for i in range(len(columns))]
    placed = Bucketizer(inputCols=list(columns), outputCols=places, splitsArray=splits,
                        handleInvalid="keep").transform(wide)
    triples = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("value"),
                                 F.col(p).cast("int").alias("bucket")) for c, p in zip(columns, places)])
    # The bucket filter changes no row; it makes both uses below one and the same shuffle.
    counted = (placed.select(F.explode(triples).alias("_v")).select("_v.*")
               .where("value IS NOT NULL AND bucket IS NOT NULL")
               .groupBy("variable", "bucket", "value").agg(F.count("*").alias("copies")))
    inside = (Window.partitionBy("variable", "bucket").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, -1))
    located = counted.withColumn("_inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    totals = counted.groupBy("variable", "bucket").agg(F.sum("copies").alias("_total"))
    earlier = Window.partitionBy("variable").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("variable", "bucket",
                            F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    # At most buckets × columns rows.
    return located.join(F.broadcast(offsets), ["variable", "bucket"]).select(
        "variable", "value", "copies", (F.col("_offset") + F.col("_inside")).alias("before"))


def running_totals(counts, value, names, buckets=None):
    """``before_<name>`` for each count column: its sum over the smaller values of a table with one row per value.

    The values are spread over buckets cut at sketch quantiles and summed up inside their bucket; the offsets are running totals
    over the buckets. The cuts only balance the work.
    """
    spark = counts.sparkSession
    buckets = buckets or max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = materialize(counts)
    cuts = counts.approxQuantile(value, [i / buckets for i in range(1, buckets)], 0.5 / buckets)
    inner = sorted({x for x in cuts if -INF < x < INF})
    placed = Bucketizer(inputCol=value, outputCol="_bucket", splits=[-INF, *(inner or [0.0]), INF]).transform(counts)
    inside = Window.partitionBy("_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    located = placed.withColumns({f"_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in names})
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in names])
    # At most as many rows as there are buckets.
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_offset_{c}") for c in names])
    return located.join(F.broadcast(offsets), "_bucket").select(
        *counts.columns, *[(F.col(f"_{c}") + F.col(f"_offset_{c}")).alias(f"before_{c}") for c in names])


def average_ranks(df, columns, buckets=None):
    """(variable, value, copies, mean_rank): ties share the mean of the ranks they cover."""
    ranks = value_ranks(df, columns, buckets)
    return ranks.select("variable", "value", "copies",
                        (F.col("before") + (F.col("copies") + 1) / 2).alias("mean_rank"))
