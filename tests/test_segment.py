"""Customer table, K-Means and silhouette against known groups and brute force."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.operators import segment, silhouette

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def blobs(spark):
    draw = np.random.default_rng(3)
    centres = np.array([[0, 0], [6, 0], [0, 6], [7, 7]], dtype=float)
    points = np.vstack([draw.normal(c, 0.5, size=(n, 2)) for c, n in zip(centres, (200, 100, 60, 40))])
    rows = [(f"c{i:04d}", float(x), float(y), int(i >= 200) + int(i >= 300) + int(i >= 360))
            for i, (x, y) in enumerate(points)]
    df = spark.createDataFrame(rows, "customer_id STRING, a DOUBLE, b DOUBLE, blob INT").repartition(4)
    return segment.scale_features(df, COLUMNS).cache()


def brute_silhouette(x, label):
    away = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(label):
        a = away[i][label == own].sum() / max((label == own).sum() - 1, 1)
        b = min(away[i][label == c].mean() for c in set(label) if c != own)
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_kmeans_finds_the_groups(blobs):
    fits = segment.fit_kmeans(blobs, COLUMNS, range(2, 7))
    costs = [fits[k][1] for k in range(2, 7)]
    assert costs == sorted(costs, reverse=True)
    assigned = segment.assign_to_centres(blobs, ["a_z", "b_z"], fits[4][0])
    sizes = assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.count_distinct("blob").alias("blobs")).collect()
    assert sorted(r["n"] for r in sizes) == [40, 60, 100, 200] and {r["blobs"] for r in sizes} == {1}


def test_best_of_ten_starts(blobs, monkeypatch):
    seeds, library = [], segment.KMeans
    monkeypatch.setattr(segment, "KMeans", lambda **given: seeds.append(given["seed"]) or library(**given))
    cost = segment.fit_kmeans(blobs, COLUMNS, [6])[6][1]
    assert len(set(seeds)) == 10
    vectors = segment.as_vectors(blobs, COLUMNS)
    costs = [library(k=6, seed=s, maxIter=300, tol=1e-4).fit(vectors).summary.trainingCost for s in seeds]
    assert cost <= min(costs) * (1 + 1e-9)


def test_k_is_left_out_only_for_want_of_points(spark):
    """Many rows of six points: every k up to six has a fit."""
    points = spark.range(20_000).select((F.col("id") % 3).cast("double").alias("a_z"), (F.col("id") % 2).cast("double").alias("b_z"))
    assert list(segment.fit_kmeans(points, COLUMNS, range(1, 9), starts=1)) == [2, 3, 4, 5, 6]


def test_silhouettes(blobs):
    rows = blobs.orderBy("customer_id").collect()
    x = np.array([[r["a_z"], r["b_z"]] for r in rows])
    label = np.array([r["blob"] for r in rows])
    assert segment.silhouette_squared(segment.as_vectors(blobs, COLUMNS), "blob") == pytest.approx(
        brute_silhouette(x, label))
    with pytest.raises(ValueError):
        segment.silhouette_squared(segment.as_vectors(blobs, COLUMNS).withColumn("blob", F.lit(1)), "blob")


def test_scaling_of_constant_and_infinite_features(spark):
    df = spark.createDataFrame([("x", 1.0, 5.0), ("y", 3.0, 5.0), ("z", float("inf"), 5.0), ("w", None, 5.0)],
                               "customer_id STRING, a DOUBLE, b DOUBLE")
    rows = segment.scale_features(df, ["a", "b"]).orderBy("customer_id").collect()
    assert [(r["customer_id"], r["a_z"], r["b_z"]) for r in rows] == [("x", -1.0, 0.0), ("y", 1.0, 0.0)]


def test_customer_table(spark):
    df = spark.createDataFrame([("a", 10.0, 2.0, 0.1), ("a", None, 3.0, 0.3), ("b", None, 1.0, None), (None, 9.0, 1.0, 0.0)],
                               "customer_id STRING, amount DOUBLE, units DOUBLE, discount_pct DOUBLE")
    rows = {r["customer_id"]: r for r in segment.customer_table(df).collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"]["amount_sum"], rows["a"]["purchase_count"], rows["a"]["amount_per_unit_mean"]) == (10.0, 2, 5.0)
    # Nothing to add up is zero, nothing to average is missing.
    assert (rows["b"]["amount_sum"], rows["b"]["amount_mean"], rows["b"]["discount_mean"]) == (0.0, None, None)
    with pytest.raises(ValueError):
        segment.customer_table(df.drop("customer_id"))
    with pytest.raises(ValueError):
        segment.usable_features(df.select("customer_id"))


def test_recency_comes_from_the_latest_lines_in_one_pass(spark):
    rows = [("a", "2024-01-01 10:00:00"), ("a", "2024-01-03 12:00:00"), ("b", "2024-01-09 13:00:00"), ("c", None), (None, "2024-01-10 12:00:00")]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, "customer_id STRING, ts STRING").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    found = segment.customer_table(df.mapInArrow(counted, df.schema))
    assert found.columns == ["customer_id", "recency_min", "purchase_count"]
    # The latest line has no customer, and counts all the same.
    assert {r["customer_id"]: r["recency_min"] for r in found.collect()} == {"a": 7.0, "b": 0.0, "c": None}
    found.count()
    assert seen.value == len(rows)


def test_profile_and_interpretation(spark):
    rows = [("a", 1, 10.0, 100.0, 5.0), ("b", 3, 30.0, 10.0, 5.0), ("c", 9, 900.0, 1.0, 5.0)]
    df = spark.createDataFrame(rows, "customer_id STRING, purchase_count BIGINT, amount_sum DOUBLE, recency_min DOUBLE, age_mean DOUBLE")
    df = df.withColumn("cluster", F.when(F.col("customer_id") == "c", 1).otherwise(0))
    columns = ["purchase_count", "amount_sum", "recency_min", "age_mean"]
    profile = {r["cluster"]: r for r in segment.cluster_profile(df, columns).collect()}
    assert (profile[0]["size"], profile[0]["amount_sum_median"], profile[1]["amount_sum_max"]) == (2, 20.0, 900.0)
    assert profile[0]["pct"] == pytest.approx(200 / 3)
    text = {r["cluster"]: r["interpretation"] for r in segment.cluster_interpretation(df, columns).collect()}
    assert text[1] == ("Cluster 1: Promedios: purchase_count alto, amount_sum alto, recency_min bajo, age_mean similar. "
                       "Clientes frecuentes y de mayor valor.")
    assert text[0].endswith("Clientes menos activos con mayor recencia.")


def lloyd(x, centres, rounds=300):
    """The plain algorithm from given centres: (centres, inertia)."""
    for _ in range(rounds):
        away = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        nearest = away.argmin(axis=1)
        fresh = np.array([x[nearest == k].mean(axis=0) for k in range(len(centres))])
        if np.allclose(fresh, centres, atol=1e-12):
            break
        centres = fresh
    return centres, ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the given tables are not here")
def test_fits_stay_where_plain_lloyd_puts_them(spark):
    """On the customers of the given tables: the returned centres are nearly fixed points and the inertia is their own sum."""
    from basketlens.plans import segment_queries
    names = [f"{c}_z" for c in segment_queries.FEATURES]
    frame = segment_queries.scaled(spark, "/root/testdata/sf0.01")
    x = frame.select(names).toPandas().to_numpy()
    for k, (centres, cost) in segment.fit_kmeans(frame, segment_queries.FEATURES, (2, 3, 5, 8), starts=3).items():
        centres = np.array(centres)
        own = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()
        assert cost == pytest.approx(own, rel=1e-9)
        moved, further = lloyd(x, centres)
        assert further <= own and further == pytest.approx(own, rel=2e-3) and np.abs(moved - centres).max() < 0.15, k


def test_fits_side_by_side_are_those_one_after_the_other(blobs):
    alone = segment.fit_kmeans(blobs, COLUMNS, range(2, 6), starts=4, at_once=1)
    assert segment.fit_kmeans(blobs, COLUMNS, range(2, 6), starts=4, at_once=8) == alone


def test_all_fits_step_in_one_pass(blobs, monkeypatch):
    """Every fit is Spark's own, and more fits don't mean more passes over the points than the longest fit needs."""
    passes, plain = [], segment._cluster_sums
    monkeypatch.setattr(segment, "_cluster_sums", lambda fits, width: passes.append(len(fits)) or plain(fits, width))
    found = segment.fit_kmeans(blobs, COLUMNS, range(2, 6), starts=2)
    vectors = segment.as_vectors(blobs, COLUMNS).select("features").coalesce(1)
    models = {(k, s): segment.KMeans(k=k, seed=segment.config.SEED + s, maxIter=300, tol=1e-4).fit(vectors) for k in range(2, 6) for s in range(2)}
    assert len(passes) == max(m.summary.numIter for m in models.values()) and passes[0] == len(models)
    for k, (centres, cost) in found.items():
        best = min((models[k, s] for s in range(2)), key=lambda m: m.summary.trainingCost)
        assert cost == pytest.approx(best.summary.trainingCost, rel=1e-9)
        assert np.allclose(sorted(centres), sorted(map(list, best.clusterCenters())))


def brute_euclidean(x, label):
    away = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    scores = []
    for i, own in enumerate(label):
        if (label == own).sum() == 1:
            scores.append(0.0)
            continue
        a = away[i][label == own].sum() / ((label == own).sum() - 1)
        b = min(away[i][label == c].mean() for c in set(label) if c != own)
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.mean(scores)


@pytest.mark.parametrize("tolerance, block", [(1e-9, 16), (1e-3, 16), (0.05, 8), (1e-9, 4096)])
def test_silhouette_by_distance(spark, blobs, tolerance, block):
    """Within the tolerance, with blocks of any size; repeated points and a cluster of one point."""
    rows = [(r["a_z"], r["b_z"], r["blob"]) for r in blobs.collect()] + [(0.5, 0.5, 1)] * 60 + [(9.0, 9.0, 7), (None, 1.0, 1)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, cluster INT").repartition(3)
    whole = [r for r in rows if r[0] is not None]
    want = brute_euclidean(np.array([r[:2] for r in whole]), np.array([r[2] for r in whole]))
    assert silhouette.silhouette_euclidean(df, ["a", "b"], tolerance=tolerance, block_points=block) == pytest.approx(want, abs=tolerance)


def test_far_cells_are_not_opened(spark):
    """Two far clusters: the other cluster's summary stands for its points, so few blocks meet as points."""
    draw = np.random.default_rng(8)
    rows = [(float(x), float(y), k) for k in (0, 1) for x, y in draw.normal(2000 * k, 1, size=(400, 2))]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, cluster INT")
    opened = []
    plain = silhouette._score
    silhouette._score = lambda d, sizes: opened.append(1) or plain(d, sizes)
    try:
        got = silhouette.silhouette_euclidean(df, ["a", "b"], tolerance=1e-5, block_points=50)
    finally:
        silhouette._score = plain
    assert opened and got == pytest.approx(brute_euclidean(np.array([r[:2] for r in rows]), np.array([r[2] for r in rows])), abs=1e-5)
    with pytest.raises(ValueError):
        silhouette.silhouette_euclidean(df.where("cluster = 0"), ["a", "b"])


def test_distances_of_points_that_nearly_agree():
    """Far from the origin and close to each other, products would lose the digits that differences keep."""
    draw = np.random.default_rng(3)
    a = np.concatenate([1e6 + draw.normal(0, 1e-3, size=(300, 3)), np.full((40, 3), 1e6)])
    b = np.concatenate([a[:280], draw.normal(0, 1, size=(20, 3))])
    away = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    by_a, by_b = silhouette._distance_sums(a, b)
    np.testing.assert_allclose(by_a, away.sum(axis=1), rtol=1e-10)
    np.testing.assert_allclose(by_b, away.sum(axis=0), rtol=1e-10)


def test_near_blocks_meet_once(monkeypatch):
    """Two blocks that ask for each other are computed once, and a block is sent once for all that it meets in a group."""
    draw = np.random.default_rng(4)
    points = {(c, b): draw.normal(size=(5, 2)) for c, b in ((0, 0), (0, 1), (1, 1))}
    rows = [{"kind": 0, "cluster": c, "block": b, "values": x.ravel().tolist()} for (c, b), x in points.items()]
    rows += [{"kind": 1, "q_cluster": q[0], "q_block": q[1], "cluster": o[0], "block": o[1]} for q in points for o in points]
    schema = pa.schema([(c, pa.int64()) for c in ("ga", "gb", "kind", "q_cluster", "q_block", "cluster", "block")] + [("values", pa.list_(pa.float64()))])
    batches = [pa.RecordBatch.from_pylist([{"ga": 0, "gb": 0, **r} for r in part], schema) for part in (rows[:5], rows[5:])]
    met, plain = [], silhouette._distance_sums
    monkeypatch.setattr(silhouette, "_distance_sums", lambda a, b: met.append(1) or plain(a, b))
    found = {(r["q_cluster"], r["q_block"], r["cluster"]): r["sums"] for batch in silhouette._near(2)(batches) for r in batch.to_pylist()}
    assert len(met) == 6 and len(found) == 6
    for (c, b, other), sums in found.items():
        theirs = np.concatenate([x for (k, _), x in points.items() if k == other])
        want = np.sqrt(((points[c, b][:, None, :] - theirs[None, :, :]) ** 2).sum(axis=2)).sum(axis=1)
        np.testing.assert_allclose(sums, want, rtol=1e-10)


@pytest.mark.parametrize("limit, how", [(silhouette.BROADCAST_BYTES, "broadcast"), (0, "merge")])
def test_pairs_of_blocks_are_never_broadcast(spark, blobs, monkeypatch, limit, how):
    """There are far more pairs than cells, in fewer bytes on disk: each join states that the cells are the side to broadcast, while small."""
    df = blobs.withColumn("cluster", F.col("blob"))
    rows = np.array(blobs.select("a", "b", "blob").collect())
    away = np.sqrt(((rows[:, None, :2] - rows[None, :, :2]) ** 2).sum(axis=2))
    means = np.array([[away[i, rows[:, 2] == c].sum() / (sum(rows[:, 2] == c) - (own == c)) for c in range(4)] for i, own in enumerate(rows[:, 2])])
    a, b = (np.array([f(m, int(own)) for m, own in zip(means, rows[:, 2])]) for f in (lambda m, own: m[own], lambda m, own: np.delete(m, own).min()))
    plans, write = [], silhouette.materialize
    monkeypatch.setattr(silhouette, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(silhouette, "materialize", lambda found: plans.append((found.columns, found._jdf.queryExecution().optimizedPlan().toString()))
                        or write(found))
    got = silhouette.silhouette_euclidean(df, ["a", "b"], tolerance=1e-6, block_points=5)
    joins = [line for columns, plan in plans if "stands" in columns for line in plan.splitlines() if "Join Inner" in line or "Join Cross" in line]
    assert len(joins) > 3 and all("rightHint=(strategy=" in line for line in joins)
    assert any(f"strategy={how})" in line for line in joins if "Join Inner" in line)
    assert got == pytest.approx(np.mean((b - a) / np.maximum(a, b)), abs=1e-6)
