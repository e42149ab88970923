"""Quantiles, modes and ranks against brute force, with hot values and forced narrow limits."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.operators import correlation, order_stats, skew

PROBABILITIES = [0.0, 0.1, 0.25, 0.33, 0.5, 0.66, 0.9, 1.0]


def column(kind, n=4000):
    draw = random.Random(7)
    return {
        "spread": [draw.uniform(-1e6, 1e6) for _ in range(n)],
        "few": [float(draw.randint(0, 4)) for _ in range(n)],
        # One value owns a third of the rows.
        "hot": [0.5 if i % 3 == 0 else draw.expovariate(1.0) for i in range(n)],
        "constant": [3.0] * n,
        "gaps": [None if i % 5 == 0 else draw.gauss(0, 1) for i in range(n)],
    }[kind]


@pytest.fixture(scope="module")
def frame(spark):
    names = ["spread", "few", "hot", "constant", "gaps"]
    rows = list(zip(*[column(c) for c in names]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} DOUBLE" for c in names)).repartition(4)
    return df.withColumn("g", F.when(F.col("few") == 0, "a").otherwise("b")).cache()


@pytest.mark.parametrize("accuracy, limit", [(10_000, 1_000_000), (50, 20), (200, 5)])
def test_quantiles(frame, accuracy, limit):
    names = frame.columns[:-1]
    found = order_stats.fit_quantiles(frame, names, PROBABILITIES, accuracy, limit)
    for c in names:
        values = [x for x in column(c) if x is not None]
        for p in PROBABILITIES:
            assert found[c, p] == (pytest.approx(np.quantile(values, p)), len(values)), (c, p)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 10, 11])
def test_quantiles_of_short_columns(spark, n):
    values = [float(i * i) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    found = order_stats.fit_quantiles(df, ["x"], PROBABILITIES)
    assert [found["x", p][0] for p in PROBABILITIES] == pytest.approx(list(np.quantile(values, PROBABILITIES)))


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "x DOUBLE")
    assert order_stats.fit_quantiles(df, ["x"], [0.5]) == {}
    assert order_stats.quantiles(df, ["x"], [0.5]).count() == 0


@pytest.mark.parametrize("accuracy", [50_000, 60])
def test_group_quantiles(frame, accuracy):
    rows = order_stats.long_values(frame, ["spread", "hot", "gaps"], ["g"])
    found = {(r["g"], r["variable"], r["probability"]): r["quantile"]
             for r in order_stats.group_quantiles(rows, [0.25, 0.5, 0.9], ["g"], accuracy).collect()}
    groups = ["a" if x == 0 else "b" for x in column("few")]
    assert len(found) == 18
    for (g, c, p), value in found.items():
        expected = np.quantile([x for x, h in zip(column(c), groups) if h == g and x is not None], p)
        assert value == pytest.approx(expected)


@pytest.mark.parametrize("buckets", [2, 8, 300])
def test_average_ranks(frame, buckets):
    found = {(r["variable"], r["value"]): (r["copies"], r["mean_rank"])
             for r in order_stats.average_ranks(frame, ["few", "hot", "gaps", "constant"], buckets).collect()}
    for c in ("few", "hot", "gaps", "constant"):
        counts, before = Counter(x for x in column(c) if x is not None), 0
        for value in sorted(counts):
            assert found[c, value] == (counts[value], before + (counts[value] + 1) / 2)
            before += counts[value]


def test_modes(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("a", None), ("b", 2.0), (None, 2.0), (None, 1.0),
                                (None, 1.0)], "t STRING, x DOUBLE")
    assert {r["variable"]: r["mode"] for r in order_stats.modes(df, ["t"]).collect()} == {"t": "a"}
    assert order_stats.numeric_modes(df, ["x"]).first()["mode"] == 1.0
    assert order_stats.numeric_modes(df, ["x"], keep_null=True).first()["mode"] is None


@pytest.mark.parametrize("limit, hot", [(100_000, 1000), (0, 1), (0, 3)])
def test_attach_by_key(spark, limit, hot):
    keys = ["h"] * 50 + ["a", "b", "c"] * 3 + [None] * 20
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k STRING, i INT").repartition(4)
    table = rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    out = skew.attach_by_key(rows, table, ["k"], "n", limit, hot).collect()
    assert len(out) == len(keys)
    assert {(r["k"], r["n"]) for r in out} == {("h", 50), ("a", 3), ("b", 3), ("c", 3), (None, None)}


def test_row_number_and_blocks(spark):
    rows = [(i % 7, "same" if i % 3 else str(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "a INT, b STRING").repartition(6)
    numbered = skew.with_row_number(df, ["a", "b"]).orderBy("row_number").collect()
    assert [r["row_number"] for r in numbered] == list(range(1, 1001))
    assert [(r["a"], r["b"]) for r in numbered] == sorted(rows)
    sizes = skew.with_blocks(df, ["a", "b"], 300).groupBy("block").count().orderBy("block").collect()
    assert [(r["block"], r["count"]) for r in sizes] == [(0, 300), (1, 300), (2, 300), (3, 100)]


def test_no_exchange_of_rows_into_one_partition(frame):
    ranks = order_stats.average_ranks(frame, ["spread", "hot"])
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_spearman_with_ties_and_gaps(frame):
    pairs = [("few", "hot"), ("gaps", "spread"), ("gaps", "few"), ("constant", "few")]
    found = {(r["var1"], r["var2"]): (r["corr"], r["n"]) for r in correlation.spearman_pairs(frame, pairs).collect()}
    for a, b in pairs:
        both = [(x, y) for x, y in zip(column(a), column(b)) if x is not None and y is not None]

        def ranks(values):
            counts, before, at = Counter(values), 0, {}
            for v in sorted(counts):
                at[v] = before + (counts[v] + 1) / 2
                before += counts[v]
            return [at[v] for v in values]

        corr, n = found[a, b]
        assert n == len(both)
        if "constant" in (a, b):
            assert corr is None
        else:
            assert corr == pytest.approx(np.corrcoef(ranks([x for x, _ in both]), ranks([y for _, y in both]))[0, 1])


def test_mode_ties_of_numbers(spark):
    df = spark.createDataFrame([(9.0, "9", 9)] * 2 + [(10.0, "10", 10)] * 2 + [(None, None, None)], "x DOUBLE, s STRING, i INT")
    found = {r["variable"]: r["mode"] for r in order_stats.modes(df, ["x", "s", "i"]).collect()}
    assert found == {"x": "9.0", "s": "10", "i": "9"}


def test_release_deletes_the_written_tables(spark):
    import os
    from basketlens.sources import staging
    table = staging.materialize(spark.range(10))
    path = table.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and 0 < staging.written_bytes(table) < 100_000
    staging.release(spark)
    assert not os.path.exists(path)
