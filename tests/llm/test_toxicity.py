import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import toxicity as m

FOLDER = "/root/testdata/sf0.01"


def test_ordinal_fit_recovers_shared_weights():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 2, (4000, 3)).astype(float)
    score = x @ np.array([2.0, -1.0, 0.0])
    noise = np.log(1 / draw.uniform(1e-9, 1, 4000) - 1)
    grades = (score + noise > 0.5).astype(int) + (score + noise > 2.0)
    rows, columns = np.nonzero(x)
    w, t = m.fit_ordinal(rows, columns, np.ones(rows.size), grades, 3, steps=1500, ridge=0.0)
    assert np.allclose(w, [2, -1, 0], atol=0.25) and np.allclose(t, [0.5, 2.0], atol=0.25)


def test_gradient_against_differences():
    """Loss falls along the fit and thresholds stay ordered."""
    grades = np.array([0, 0, 1, 2, 2, 1])
    rows, columns = np.array([2, 3, 4, 5]), np.array([0, 1, 1, 0])
    w, t = m.fit_ordinal(rows, columns, np.ones(4), grades, 2, steps=800, ridge=1e-3)
    model = m.OrdinalModel(np.array([1, 2], np.uint64), w, t)
    p = model.probabilities(np.bincount(rows, weights=w[columns], minlength=6))
    assert t[0] <= t[1] and (p[:, 0] >= p[:, 1]).all() and p[3:5, 1].min() > p[0, 1]


@pytest.fixture(scope="module")
def model(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("the given tables are not here")
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    return docs, labels.where(half == 1), m.train(docs, labels.where(half == 0))


def test_held_out_accuracy(model):
    docs, held, fitted = model
    got = docs.select("doc_id", m.severity(F.col("text"), fitted).alias("s")).join(held, "doc_id").select(
        "toxic", (F.col("s.at_least_1") >= m.REJECT_AT).alias("found"), "s.expected").toPandas()
    toxic = got[got.toxic == 1]
    assert (got[got.toxic == 0].found == 0).mean() > 0.98 and toxic.found.mean() > 0.6
    assert toxic.expected.mean() > 4 * got[got.toxic == 0].expected.mean()


def test_odd_rows_pass_through(spark, model):
    rows = [(1, None, 5, "a"), (None, "", 5, "b"), (2, "stupid idiot " * 3, 5, "c"), (2, "stupid idiot " * 3, 5, "c"), (3, "x " * 100_000, 5, "d")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, toxic INT, _severity STRING")
    kept = m.without_toxic(docs, model[2])
    assert kept.columns == docs.columns and sorted(r["_severity"] for r in kept.collect()) in (["a", "b", "d"], list("abccd"))
    assert m.without_toxic(docs.limit(0), model[2]).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(1, 0), (None, 1), (1, None)], "doc_id LONG, toxic INT")
    assert m.train(docs, labels) is None
    assert m.without_toxic(docs, None).count() == 1


def plain_loss(theta, x, grades):
    """Minus the mean log-likelihood, by a loop over rows."""
    w, t = theta[:2], sorted(theta[2:])
    total = 0.0
    for row, grade in zip(x, grades):
        score = row @ w
        above = [1.0] + [1 / (1 + np.exp(c - score)) for c in t] + [0.0]
        total -= np.log(max(above[grade] - above[grade + 1], 1e-12))
    return total / len(grades)


def test_fit_against_a_plain_optimiser():
    """Pattern search on the loss finds the same weights and thresholds."""
    draw = np.random.default_rng(5)
    x = draw.integers(0, 2, (150, 2)).astype(float)
    noise = np.log(1 / draw.uniform(1e-9, 1, 150) - 1)
    score = x @ np.array([1.5, -1.0]) + noise
    grades = (score > 0.2).astype(int) + (score > 1.5)
    theta, step = np.array([0.0, 0.0, 0.0, 1.0]), 1.0
    best = plain_loss(theta, x, grades)
    while step > 1e-4:
        tries = [theta + step * s * np.eye(4)[k] for k in range(4) for s in (1, -1)]
        losses = [plain_loss(t, x, grades) for t in tries]
        if min(losses) < best:
            best, theta = min(losses), tries[int(np.argmin(losses))]
        else:
            step /= 2
    rows, columns = np.nonzero(x)
    w, t = m.fit_ordinal(rows, columns, np.ones(rows.size), grades, 2, steps=3000, ridge=0.0)
    assert plain_loss(np.concatenate([w, t]), x, grades) == pytest.approx(best, abs=1e-6)
    assert np.allclose(np.concatenate([w, t]), theta, atol=2e-2)
