"""Customer table, standardization, K-Means, silhouette and cluster reports."""

from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from basketlens import config
from basketlens.config import present
from basketlens.functions import columns as C
from basketlens.operators import features, order_stats
from basketlens.operators.silhouette import silhouette_euclidean
from basketlens.sources.staging import materialize, temporary


def customer_table(df, customer="customer_id"):
    """One row per customer: means, sum and minimum of the sales lines, and their number.

    Derived inputs that are missing are computed first. Lines without a customer are left out. Recency, where it is missing,
    comes from each customer's latest line: full days fall with time, so the least of them is that line's, and the latest of
    all lines is the latest of these, those without a customer included. The lines are read once.
    """
    if customer not in df.columns:
        raise ValueError(f"customer table needs the column {customer}")
    have = set(df.columns)
    if "age" not in have and "birth_date" in have:
        df = df.withColumn("age", features.age())
    if "amount_per_unit" not in have and {"amount", "units"} <= have:
        df = df.withColumn("amount_per_unit", features.amount_per_unit())
    summary = {
        "amount_mean": ("amount", F.avg),
        # A sum over nothing is zero, as in a data frame library that skips missing values.
        "amount_sum": ("amount", lambda c: F.coalesce(F.sum(c), F.lit(0.0))),
        "discount_mean": ("discount_pct", F.avg),
        "age_mean": ("age", F.avg),
        "recency_min": ("recency_days", F.min),
        "amount_per_unit_mean": ("amount_per_unit", F.avg),
    }
    sums = {name: f(C.number(df, c)) for name, (c, f) in summary.items() if c in df.columns}
    sums["purchase_count"] = F.count("*")
    if "recency_days" in have or "ts" not in have:
        return df.where(F.col(customer).isNotNull()).groupBy(customer).agg(*[f.alias(name) for name, f in sums.items()])
    found = materialize(df.groupBy(customer).agg(*[f.alias(name) for name, f in sums.items()], F.max("ts").alias("_latest")))
    recency = features.full_days_between(F.col("_latest"), found.agg(F.max("_latest")).scalar()).cast("double")
    names = [name for name in [*summary, "purchase_count"] if name in sums or name == "recency_min"]
    return found.where(F.col(customer).isNotNull()).withColumn("recency_min", recency).select(customer, *names)


def usable_features(customers, wanted=config.CLUSTER_FEATURES):
    found = present(customers, wanted)
    if not found:
        raise ValueError("no numeric columns to cluster the customers by")
    return found


def clean_features(customers, features_used):
    """Infinite values become null, customers with a null are left out."""
    numbers = {c: C.finite(C.number(customers, c)) for c in features_used}
    return customers.withColumns(numbers).na.drop(subset=features_used)


def scale_features(customers, columns=None, suffix="_z"):
    """Clean, then (x − mean) / population deviation; a constant column is only centred."""
    columns = columns or usable_features(customers)
    cleaned = clean_features(customers, columns)
    one = cleaned.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(c)
                        for c in columns]).first()
    return cleaned.withColumns({c + suffix: (F.col(c) - one[c]["mean"]) / (one[c]["sd"] or 1.0)
                                for c in columns if one[c]["mean"] is not None})


def as_vectors(scaled, columns, suffix="_z"):
    return VectorAssembler(inputCols=[c + suffix for c in columns], outputCol="features").transform(scaled)


# ---- K-Means ----------------------------------------------------------------------------

def _some_different(names, most):
    """Up to ``most`` different rows of a partition, which is read no further than needed."""
    def run(batches):
        seen = set()
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in names)):
                seen.add(row)
                if len(seen) >= most:
                    break
            if len(seen) >= most:
                break
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in (zip(*seen) if seen else [[]] * len(names))], names)
    return run


def _count_different(points, most):
    """How many different points there are, counted up to ``most``."""
    few = points.mapInArrow(_some_different(points.columns, most), points.schema)
    return few.distinct().limit(most).count()


def _packed(names):
    """The points of each batch as one block of bytes, row by row."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                block = np.column_stack([batch[c].to_numpy(zero_copy_only=False) for c in names])
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(block, np.float64).tobytes()], pa.binary())], ["block"])
    return run


def _points_of(batches, width):
    for batch in batches:
        for block in batch["block"]:
            yield np.frombuffer(block.as_buffer(), np.float64).reshape(-1, width)


def _nearest(x, centres):
    """The number of each point's nearest centre, the lowest on ties; the point's own square is left out of all distances."""
    away = (centres * centres).sum(axis=1)[:, None] - 2 * (centres @ x.T)
    best, nearest = away[0], np.zeros(len(x), np.int64)
    for i in range(1, len(centres)):
        nearest[away[i] < best] = i
        best = np.minimum(best, away[i])
    return nearest


def _cluster_sums(fits, width):
    """(fit, centre, n, sums of the points nearest to it) of a task's points, for {fit: centres}."""
    def run(batches):
        sums = {fit: np.zeros((len(centres), 1 + width)) for fit, centres in fits.items()}
        for x in _points_of(batches, width):
            for fit, centres in fits.items():
                own = (_nearest(x, centres) == np.arange(len(centres))[:, None]).astype(np.float64)
                sums[fit][:, 0] += own.sum(axis=1)
                sums[fit][:, 1:] += own @ x
        flat = np.concatenate(list(sums.values()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([fit for fit, s in sums.items() for _ in s], pa.int32()), pa.array([i for s in sums.values() for i in range(len(s))], pa.int32()),
             *[pa.array(column) for column in flat.T]], ["fit", "centre", "n", *[f"s{j}" for j in range(width)]])
    return run


def _inertias(fits, width):
    """(fit, inertia) of a task's points, by differences."""
    def run(batches):
        costs = dict.fromkeys(fits, 0.0)
        for x in _points_of(batches, width):
            for fit, centres in fits.items():
                apart = x - centres[_nearest(x, centres)]
                costs[fit] += float((apart * apart).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(costs), pa.int32()), pa.array(list(costs.values()), pa.float64())], ["fit", "inertia"])
    return run


def _lloyd(blocks, starts, width, max_iter, tolerance):
    """[(centres, inertia)] of Lloyd's iteration from each of the starts, all of them moved in one pass over the points.

    As in Spark's K-Means a fit ends when no centre moves by more than the tolerance, a centre without points stays, and the
    inertia is that of the last assignment, made by the centres before they moved last.
    """
    centres, before, open_ = list(starts), list(starts), range(len(starts))
    sums = ", ".join(f"s{j} DOUBLE" for j in range(width))
    for _ in range(max_iter):
        if not open_:
            break
        found = (blocks.mapInArrow(_cluster_sums({i: centres[i] for i in open_}, width), f"fit INT, centre INT, n DOUBLE, {sums}")
                 .groupBy("fit", "centre").agg(F.sum("n"), *[F.sum(f"s{j}") for j in range(width)]).collect())
        for i in open_:
            before[i], centres[i] = centres[i], centres[i].copy()
        for fit, centre, n, *total in found:  # one row per centre
            if n:
                centres[fit][centre] = np.array(total) / n
        open_ = [i for i in open_ if ((centres[i] - before[i]) ** 2).sum(axis=1).max() > tolerance ** 2]
    costs = dict(blocks.mapInArrow(_inertias(dict(enumerate(before)), width), "fit INT, inertia DOUBLE").groupBy("fit").agg(F.sum("inertia")).collect())
    return [(centres[i], costs[i]) for i in range(len(starts))]


def fit_kmeans(scaled, columns, ks=(config.CLUSTERS,), starts=config.KMEANS_STARTS, seed=config.SEED,
               max_iter=300, tolerance=1e-4, suffix="_z", at_once=config.FITS_AT_ONCE):
    """{k: (centres, inertia)}: the best of several seeded fits for every k, each over all rows.

    A k below two, or beyond the number of different points, has no fit and is left out. The first centres are those of Spark's
    K-Means (k-means||), a chain of short jobs for each fit, so up to ``at_once`` are found side by side, each in a thread of the driver.
    Then all fits take their steps together: a pass over the points, packed in blocks, moves the centres of every fit that has
    not come to rest, and the sums by centre are all that leaves a task. What a fit finds doesn't depend on the others. Vectors and
    blocks are kept on the executors' disks and memory, in as many partitions as their bytes need.
    """
    names = [c + suffix for c in columns]
    ks = sorted(set(ks))
    if not ks:
        return {}
    points = scaled.select(*[F.col(c).cast("double").alias(c) for c in names])
    different = _count_different(points, max(ks))
    jobs = [(k, start) for start in range(starts) for k in reversed(ks) if 2 <= k <= different]
    if not jobs:
        return {}
    size = scaled.count() * len(names) * 8
    spark = scaled.sparkSession
    vectors = as_vectors(scaled, columns, suffix).select("features").coalesce(max(1, -(-size // config.VECTOR_BYTES))).persist()
    try:
        vectors.count()  # kept before the fits start together

        @inheritable_thread_target(spark)
        def begin(job):
            k, start = job
            model = KMeans(k=k, seed=seed + start, maxIter=0, tol=tolerance).fit(vectors)
            return np.array([list(c) for c in model.clusterCenters()], np.float64)

        with ThreadPool(max(1, min(at_once, len(jobs)))) as threads:
            begun = threads.map(begin, jobs, chunksize=1)
    finally:
        vectors.unpersist()
    blocks = points.coalesce(max(1, -(-size // config.BLOCK_BYTES))).mapInArrow(_packed(names), "block BINARY").persist()
    try:
        found = [(k, cost, start, centres) for (k, start), (centres, cost)
                 in zip(jobs, _lloyd(blocks, begun, len(names), max_iter, tolerance))]
    finally:
        blocks.unpersist()
    fits = {}
    for k, cost, _, centres in sorted(found, key=lambda f: f[:3], reverse=True):
        fits[k] = centres.tolist(), cost
    return dict(sorted(fits.items()))


def elbow(scaled, columns, ks=config.ELBOW_RANGE, starts=config.KMEANS_STARTS, seed=config.SEED):
    """(k, inertia) for each k; the result has one row per k."""
    fits = fit_kmeans(scaled, columns, ks, starts, seed)
    return elbow_table(scaled.sparkSession, fits)


def elbow_table(spark, fits):
    return spark.createDataFrame([(k, cost) for k, (_, cost) in sorted(fits.items())], "k BIGINT, inertia DOUBLE")


def assign_to_centres(df, columns, centres, name="cluster"):
    """Nearest given centre by squared distance, the lowest number on ties; no join."""
    def distance(centre):
        return sum(((F.col(c) - float(x)) ** 2 for c, x in zip(columns, centre)), F.lit(0.0))

    options = F.array(*[F.struct(distance(centre).alias("distance"), F.lit(i).cast("bigint").alias("id"))
                        for i, centre in enumerate(centres)])
    return df.withColumn(name, F.array_min(options)["id"])


def silhouette_squared(vectors, cluster="cluster"):
    """Mean silhouette by squared Euclidean distance over all rows, in one linear pass."""
    if vectors.agg(F.min(cluster) == F.max(cluster)).first()[0]:
        raise ValueError("a silhouette needs at least two clusters")
    return ClusteringEvaluator(predictionCol=cluster, distanceMeasure="squaredEuclidean").evaluate(
        vectors.withColumn(cluster, F.col(cluster).cast("double")))


def clustering_metrics(assigned, k, columns, score, cluster="cluster"):
    """(model, k, silhouette, n_customers, variables)"""
    return assigned.agg(F.count(cluster).alias("n_customers")).select(
        F.lit("KMeans").alias("model"), F.lit(k).cast("bigint").alias("k"), F.lit(float(score)).alias("silhouette"),
        "n_customers", F.lit(", ".join(columns)).alias("variables"))


def cluster_profile(assigned, columns, cluster="cluster"):
    """One row per cluster: size, share, and mean, median, min and max of each feature."""
    total = assigned.count()
    sizes = assigned.groupBy(cluster).agg(
        F.count("*").alias("size"),
        *[f(c).alias(f"{c}_{name}") for c in columns for name, f in (("mean", F.avg), ("min", F.min), ("max", F.max))])
    medians = order_stats.group_quantiles(
        order_stats.long_values(assigned, columns, [cluster]), [0.5], [cluster]).groupBy(cluster).agg(
        *[F.max(F.when(F.col("variable") == c, F.col("quantile"))).alias(f"{c}_median") for c in columns])
    ordered = [f"{c}_{name}" for c in columns for name in ("mean", "median", "min", "max")]
    return (sizes.join(medians, cluster)
            .select(cluster, "size", (F.col("size") * 100.0 / total).alias("pct"), *ordered).orderBy(cluster))


def cluster_interpretation(assigned, columns, cluster="cluster", tolerance=0.0):
    """(cluster, interpretation): each feature's cluster mean against the overall mean, in words."""
    overall = assigned.agg(*[F.avg(c).alias(c) for c in columns]).first()
    means = assigned.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])

    def above(c):
        return F.col(c) > overall[c] + tolerance

    def below(c):
        return F.col(c) < overall[c] - tolerance

    levels = [F.concat(F.lit(f"{c} "), F.when(above(c), config.LEVEL_ABOVE).when(below(c), config.LEVEL_BELOW).otherwise(config.LEVEL_SAME))
              for c in columns]
    phrase = F.lit(None).cast("string")
    if {"purchase_count", "amount_sum"} <= set(columns):
        phrase = F.when(above("purchase_count") & above("amount_sum"), config.PHRASE_FREQUENT)
        if "recency_min" in columns:
            phrase = phrase.when(below("purchase_count") & above("recency_min"),
                                 config.PHRASE_INACTIVE)
    text = F.concat_ws(" ", F.concat(F.lit("Cluster "), F.col(cluster).cast("string"), F.lit(":")),
                       F.concat(F.lit("Promedios: "), F.concat_ws(", ", *levels), F.lit(".")), phrase)
    return means.select(cluster, text.alias("interpretation"))


def segment_customers(df, k=config.CLUSTERS, starts=config.KMEANS_STARTS, seed=config.SEED,
                      ks=config.ELBOW_RANGE):
    """The whole segmentation of prepared sales lines.

    Returns the assigned customers and the elbow, metrics, profile and interpretation tables.
    The customers are written before they are scaled, and the scaled ones before the fits, which pass
    over them many times; then the former are deleted.
    """
    with temporary(df.sparkSession) as keep:
        customers = materialize(customer_table(df))
        columns = usable_features(customers)
        scaled = keep(materialize(scale_features(customers, columns)))
    if scaled.isEmpty():
        raise ValueError("no customers left to cluster after removing null and infinite values")
    fits = fit_kmeans(scaled, columns, {k, *ks}, starts, seed)
    if k not in fits:
        raise ValueError(f"there are fewer than {k} different customers to cluster")
    assigned = assign_to_centres(scaled, [c + "_z" for c in columns], fits[k][0])
    score = silhouette_euclidean(assigned, [c + "_z" for c in columns], tolerance=config.SILHOUETTE_TOLERANCE)
    return {
        "customers": assigned,
        "elbow": elbow_table(df.sparkSession, {n: fits[n] for n in ks if n in fits}),
        "metrics": clustering_metrics(assigned, k, columns, score),
        "profile": cluster_profile(assigned, columns),
        "interpretation": cluster_interpretation(assigned, columns),
    }
