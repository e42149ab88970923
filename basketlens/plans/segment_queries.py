"""Customer segmentation."""

from pyspark.sql import Window, functions as F

from basketlens import config
from basketlens.operators import features, plotdata, quality, segment
from basketlens.operators.silhouette import silhouette_euclidean
from basketlens.plans.catalog import query
from basketlens.plans.plot_queries import grid_sql
from basketlens.plans.quality_queries import rounded, sink
from basketlens.sources import delimited
from basketlens.plans.sales_view import customers, oracle, staged, valid
from basketlens.sources.staging import discard

FEATURES = config.CLUSTER_FEATURES
# Labels that both engines can compute, so that the reports have a SQL equivalent.
LABELLED_SQL = ("k AS (SELECT *, purchase_count % 3 AS cluster FROM customers WHERE "
                + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES) + ")")


def complete(spark, d):
    """Customers with all features; ``customers`` has written them, so reports may pass over them several times."""
    return segment.clean_features(customers(spark, d), FEATURES)


def labelled(spark, d):
    return complete(spark, d).withColumn("cluster", F.pmod("purchase_count", F.lit(3)).cast("bigint"))


def scaled(spark, d):
    """Scaled customers, written before the fits pass over them many times."""
    return staged(segment.scale_features(customers(spark, d), FEATURES))


def clustered(spark, d):
    frame = scaled(spark, d)
    centres, _ = segment.fit_kmeans(frame, FEATURES)[config.CLUSTERS]
    return segment.assign_to_centres(frame, [f"{c}_z" for c in FEATURES], centres)


# Means as single precision: a decimal rounding would hit exact ties.
@query("customer_table", oracle("customers", """
SELECT customer_id, CAST(CAST(amount_mean AS FLOAT) AS DOUBLE) AS amount_mean, round(amount_sum, 4) AS amount_sum,
  CAST(CAST(discount_mean AS FLOAT) AS DOUBLE) AS discount_mean, CAST(CAST(age_mean AS FLOAT) AS DOUBLE) AS age_mean,
  recency_min, CAST(CAST(amount_per_unit_mean AS FLOAT) AS DOUBLE) AS amount_per_unit_mean, purchase_count
FROM customers"""))
def customer_table(spark, d):
    found = rounded(customers(spark, d), 4, "amount_sum")
    return found.withColumns({c: F.col(c).cast("float").cast("double")
                              for c in ("amount_mean", "discount_mean", "age_mean", "amount_per_unit_mean")})


@query("customer_features_scaled", oracle("customers", LABELLED_SQL + ", p AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS {c}_s" for c in FEATURES)
    + " FROM k) SELECT customer_id, " + ", ".join(f"round(({c} - {c}_m) / {c}_s, 6) AS {c}_z" for c in FEATURES)
    + " FROM k, p"))
def customer_features_scaled(spark, d):
    names = [f"{c}_z" for c in FEATURES]
    return rounded(segment.scale_features(customers(spark, d), FEATURES).select("customer_id", *names), 6, *names)


CENTRE_COLUMNS = ["amount_mean", "recency_min", "purchase_count"]
CENTRES = [(40_000.0, 20.0, 30.0), (50_000.0, 60.0, 40.0), (60_000.0, 120.0, 60.0)]


def distance_sql(centre):
    return " + ".join(f"power({c} - {x}::DOUBLE, 2)" for c, x in zip(CENTRE_COLUMNS, centre))


@query("assign_to_centres", oracle("customers", f"""{LABELLED_SQL},
s AS (SELECT customer_id, {', '.join(f'{distance_sql(c)} AS d{i}' for i, c in enumerate(CENTRES))} FROM k)
SELECT customer_id, CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS BIGINT) AS cluster
FROM s"""))
def assign_to_centres(spark, d):
    return segment.assign_to_centres(complete(spark, d), CENTRE_COLUMNS, CENTRES).select("customer_id", "cluster")


@query("sink_clusters", oracle("customers", f"""{LABELLED_SQL},
s AS (SELECT customer_id, {', '.join(f'{distance_sql(c)} AS d{i}' for i, c in enumerate(CENTRES))} FROM k)
SELECT customer_id, CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS BIGINT) AS cluster
FROM s"""))
def sink_clusters(spark, d):
    """The assignment as files, read back."""
    path = sink(spark, "clusters")
    delimited.write_clusters(assign_to_centres(spark, d), path)
    return spark.read.parquet(path)


PROFILE = [f"{c}_{s}" for c in FEATURES for s in ("mean", "median", "min", "max")]


@query("cluster_profile", oracle("customers", LABELLED_SQL + """
SELECT cluster, count(*) AS size, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM k), 6) AS pct, """ + ", ".join(
    f"round(avg({c}), 6) AS {c}_mean, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS {c}_median, "
    f"round(min({c})::DOUBLE, 6) AS {c}_min, round(max({c})::DOUBLE, 6) AS {c}_max" for c in FEATURES)
    + " FROM k GROUP BY cluster"))
def cluster_profile(spark, d):
    return rounded(rounded(segment.cluster_profile(labelled(spark, d), FEATURES), 6, "pct"), 6, *PROFILE)


def level_sql(c):
    return f"'{c} ' || CASE WHEN m.{c} > g.{c} THEN 'alto' WHEN m.{c} < g.{c} THEN 'bajo' ELSE 'similar' END"


MEANS = ", ".join(f"avg({c}) AS {c}" for c in FEATURES)


@query("cluster_interpretation", oracle("customers", f"""{LABELLED_SQL},
m AS (SELECT cluster, {MEANS} FROM k GROUP BY cluster), g AS (SELECT {MEANS} FROM k)
SELECT m.cluster, 'Cluster ' || m.cluster || ': Promedios: ' || {" || ', ' || ".join(level_sql(c) for c in FEATURES)} || '.' ||
  CASE WHEN m.purchase_count > g.purchase_count AND m.amount_sum > g.amount_sum
       THEN ' Clientes frecuentes y de mayor valor.'
       WHEN m.purchase_count < g.purchase_count AND m.recency_min > g.recency_min
       THEN ' Clientes menos activos con mayor recencia.' ELSE '' END AS interpretation FROM m, g"""))
def cluster_interpretation(spark, d):
    return segment.cluster_interpretation(labelled(spark, d), FEATURES)


def grid(x, y):
    return grid_sql(x, y, "k", 20, "cluster")


@query("cluster_scatter_bins", oracle("customers", f"""{LABELLED_SQL}
SELECT 'amount_sum x purchase_count' AS plot, * FROM ({grid('amount_sum', 'purchase_count')})
UNION ALL SELECT 'recency_min x amount_sum', * FROM ({grid('recency_min', 'amount_sum')})"""))
def cluster_scatter_bins(spark, d):
    frame = labelled(spark, d)
    plots = [plotdata.scatter_bins(frame, x, y, 20, ["cluster"]).select(F.lit(f"{x} x {y}").alias("plot"), "*")
             for x, y in (("amount_sum", "purchase_count"), ("recency_min", "amount_sum"))]
    return plots[0].unionByName(plots[1])


# Mean squared distance from a point to a cluster follows from the cluster's count, sum and sum
# of squares, which the statement spells out.
SCALED_SQL = (LABELLED_SQL + ", p AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in FEATURES) + " FROM k), z AS (SELECT customer_id, cluster, " + ", ".join(f"({c} - {c}_m) / {c}_s AS {c}" for c in FEATURES)
    + " FROM k, p)")
SQUARES = " + ".join(f"power({c}, 2)" for c in FEATURES)


@query("silhouette", oracle("customers", f"""{SCALED_SQL},
c AS (SELECT cluster AS other, count(*) AS n, sum({SQUARES}) AS psi, {', '.join(f'sum({f}) AS {f}_y' for f in FEATURES)}
      FROM z GROUP BY cluster),
t AS (SELECT customer_id, cluster, other, n,
        {SQUARES} + psi / n - 2 * ({' + '.join(f'{f} * {f}_y' for f in FEATURES)}) / n AS away FROM z, c),
s AS (SELECT customer_id, max(away * n / (n - 1)) FILTER (WHERE cluster = other) AS a,
        min(away) FILTER (WHERE cluster <> other) AS b FROM t GROUP BY customer_id)
SELECT 'squared euclidean' AS measure, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM s"""))
def silhouette(spark, d):
    frame = scaled(spark, d).withColumn("cluster", F.pmod("purchase_count", F.lit(3)))
    score = segment.silhouette_squared(segment.as_vectors(frame, FEATURES))
    return frame.agg(F.lit("squared euclidean").alias("measure"), F.round(F.lit(score), 6).alias("silhouette"))


DISTANCE = "sqrt(" + " + ".join(f"power(a.{c} - b.{c}, 2)" for c in FEATURES) + ")"


@query("silhouette_euclidean", oracle("customers", f"""{SCALED_SQL},
t AS (SELECT a.customer_id, a.cluster, b.cluster AS other, sum({DISTANCE}) AS away, count(*) AS n FROM z a, z b GROUP BY ALL),
s AS (SELECT customer_id, max(away / (n - 1)) FILTER (WHERE cluster = other) AS a,
        min(away / n) FILTER (WHERE cluster <> other) AS b FROM t GROUP BY customer_id)
SELECT 'euclidean' AS measure, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM s"""))
def silhouette_by_distance(spark, d):
    frame = scaled(spark, d).withColumn("cluster", F.pmod("purchase_count", F.lit(3)))
    score = silhouette_euclidean(frame, [f"{c}_z" for c in FEATURES], tolerance=1e-9)
    return frame.agg(F.lit("euclidean").alias("measure"), F.round(F.lit(score), 6).alias("silhouette"))


METRICS_NAMES = ", ".join(FEATURES)


@query("clustering_metrics_fixed", oracle("customers", f"""{SCALED_SQL},
c AS (SELECT cluster AS other, count(*) AS n, sum({SQUARES}) AS psi, {', '.join(f'sum({f}) AS {f}_y' for f in FEATURES)}
      FROM z GROUP BY cluster),
t AS (SELECT customer_id, cluster, other, n,
        {SQUARES} + psi / n - 2 * ({' + '.join(f'{f} * {f}_y' for f in FEATURES)}) / n AS away FROM z, c),
s AS (SELECT customer_id, max(away * n / (n - 1)) FILTER (WHERE cluster = other) AS a,
        min(away) FILTER (WHERE cluster <> other) AS b FROM t GROUP BY customer_id)
SELECT 'KMeans' AS model, CAST(3 AS BIGINT) AS k, round(avg((b - a) / greatest(a, b)), 6) AS silhouette,
  count(*) AS n_customers, '{METRICS_NAMES}' AS variables FROM s"""))
def clustering_metrics_fixed(spark, d):
    """The metrics table for labels that both engines can compute."""
    frame = scaled(spark, d).withColumn("cluster", F.pmod("purchase_count", F.lit(3)))
    score = segment.silhouette_squared(segment.as_vectors(frame, FEATURES))
    return rounded(segment.clustering_metrics(frame, config.CLUSTERS, FEATURES, score), 6, "silhouette")


ELBOW_KS = ", ".join(f"({k})" for k in config.ELBOW_RANGE)


@query("kmeans_elbow_checks", oracle("customers", f"""{LABELLED_SQL}, p AS (SELECT count(*) AS n FROM k)
SELECT CAST(e.k AS BIGINT) AS k, true AS below_previous, p.n * {len(FEATURES)} AS total_inertia, true AS below_total
FROM (VALUES {ELBOW_KS}) e(k), p"""))
def kmeans_elbow_checks(spark, d):
    """What must hold for the elbow: a fit for each k, inertia that falls with k and stays below that of one cluster.

    The inertia of one cluster is the number of scaled values, whose variance is one.
    """
    frame = scaled(spark, d)
    found = segment.elbow(frame, FEATURES)
    total = frame.count() * len(FEATURES)
    before = F.coalesce(F.lag("inertia").over(Window.orderBy("k")), F.lit(float(total)))
    return found.select("k", (F.col("inertia") < before).alias("below_previous"), F.lit(total).cast("bigint").alias("total_inertia"),
                        (F.col("inertia") < total).alias("below_total"))


@query("kmeans_assign_checks", oracle("customers", f"""{LABELLED_SQL}
SELECT count(*) AS n_customers, CAST({config.CLUSTERS} AS BIGINT) AS n_clusters, true AS better_than_labels FROM k"""))
def kmeans_assign_checks(spark, d):
    """Every customer has one of k clusters, and their silhouette is above that of arbitrary labels."""
    found = clustered(spark, d)
    vectors = segment.as_vectors(found, FEATURES)
    arbitrary = vectors.withColumn("cluster", F.pmod("purchase_count", F.lit(config.CLUSTERS)))
    better = segment.silhouette_squared(vectors) > segment.silhouette_squared(arbitrary)
    return found.agg(F.count("cluster").alias("n_customers"), F.count_distinct("cluster").alias("n_clusters"),
                     F.lit(better).alias("better_than_labels"))


@query("kmeans_elbow")
def kmeans_elbow(spark, d):
    return segment.elbow(scaled(spark, d), FEATURES)


@query("kmeans_assign")
def kmeans_assign(spark, d):
    return clustered(spark, d).select("customer_id", "cluster")


@query("clustering_metrics")
def clustering_metrics(spark, d):
    """The metrics of the fitted clusters, with the silhouette by distance."""
    assigned = clustered(spark, d)
    score = silhouette_euclidean(assigned, [f"{c}_z" for c in FEATURES], tolerance=config.SILHOUETTE_TOLERANCE)
    return segment.clustering_metrics(assigned, config.CLUSTERS, FEATURES, score)


@query("segment_customers")
def segment_customers(spark, d):
    """Cleaned and derived lines through the whole segmentation; the profile of its clusters."""
    wanted = ["amount_per_unit", "age", "recency_days"]
    written = staged(valid(spark, d))
    lines = quality.validate_derived(features.derive_features(quality.clean_base(written), wanted))
    found = segment.segment_customers(lines)
    discard(written)  # the tables come from the scaled customers
    return found["profile"]
