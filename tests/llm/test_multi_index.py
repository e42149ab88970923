import itertools

import numpy as np
import pytest

from basketlens.llm import multi_index as m

QUERY = "pmod(vec_id, 50) = 0"
SCHEMA = "vec_id LONG, embedding ARRAY<DOUBLE>, first STRING"


def brute(rows, k=5):
    good = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v is not None and None not in v and len(v) == 8
            and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = {}
    for q, x in good:
        if q % 50 == 0:
            score = sorted((-(y * x).sum() / (np.sqrt((y * y).sum()) * np.sqrt((x * x).sum())), i) for i, y in good if i != q)
            out[q] = [(i, -s) for s, i in score[:k]]
    return out


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, 8))
    out = [(k, (centres[k % 20] + 0.3 * draw.normal(size=8)).tolist()) for k in range(1500)]
    out += [(2000 + k, out[0][1]) for k in range(700)]  # one very common vector
    out += [(5000, None), (5050, [0.0] * 8), (5100, [None] + [1.0] * 7), (5150, [float("nan")] * 8), (None, [1.0] * 8), (5200, [1.0, 2.0]),
            (5250, [float("inf")] + [0.0] * 7)]
    return [(*r, "x") for r in out]


def test_all_cells_give_the_exact_answer(spark, rows):
    found = m.search(spark.createDataFrame(rows, SCHEMA).repartition(4), QUERY, share=1.0, centroids=6).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-15)


def test_blocks_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_ROWS", 50)
    test_all_cells_give_the_exact_answer(spark, rows)


def test_repeated_rows(spark, monkeypatch):
    """Query rows twice and seven times, one id with two vectors, and copies of a neighbour, against brute force."""
    monkeypatch.setattr(m, "BLOCK_ROWS", 50)
    draw = np.random.default_rng(8)
    out = [(k, draw.normal(size=8).tolist()) for k in range(400)]
    near = (np.array(out[0][1]) + 0.01).tolist()
    out += [out[0]] + [out[50]] * 6 + [(100, draw.normal(size=8).tolist())] + [(901, near)] * 3 + [out[150]] * 120
    found = m.search(spark.createDataFrame([(*r, "x") for r in out], SCHEMA).repartition(4), QUERY, share=1.0, centroids=6).collect()
    got, want = {}, {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 12)))
    for q in range(0, 400, 50):
        asked = [np.array(v) for i, v in out if i == q]
        best = sorted((-max((x @ np.array(v)) / np.sqrt((x @ x) * np.dot(v, v)) for x in asked), i) for i, v in out if i != q)[:5]
        want[q] = [(n, i, round(-s, 12)) for n, (s, i) in enumerate(best, 1)]
    assert got == want
    assert [i for _, i, _ in got[0]][:3] == [901] * 3


def test_recall_of_a_part(spark, rows):
    found = m.search(spark.createDataFrame(rows, SCHEMA), QUERY, share=0.45, least=100, centroids=8).collect()
    want = brute(rows)
    near = {q: min(s for _, s in w) for q, w in want.items()}
    assert sum(r["score"] >= near[r["query_id"]] - 1e-12 for r in found) >= 0.9 * sum(map(len, want.values()))


def test_walk_is_in_order_of_distance():
    draw = np.random.default_rng(5)
    one, two = draw.random(7), draw.random(9)
    sizes = {(i, j): 1 for i, j in itertools.product(range(7), range(9)) if (i + j) % 3}
    walked = m.walk(one, two, sizes, 1000)
    assert walked == sorted(sizes, key=lambda c: one[c[0]] + two[c[1]])
    assert m.walk(one, two, sizes, 4) == walked[:4]


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], "x"), (1, [0.0, 1.0], "x")], SCHEMA)
    assert [tuple(r) for r in m.search(few, QUERY).collect()] == [(0, 1, 1, 0.0)]
    assert m.search(few.limit(0), QUERY).count() == 0
