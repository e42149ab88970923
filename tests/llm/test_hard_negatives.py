import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import hard_negatives as m

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, row STRING, block INT, copies STRING, q STRING"


def plainly(rows, every, positives=5, negatives=10):
    """All pairs of every anchor in a sorted list."""
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
              if v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (anchor, x, own) in enumerate(usable):
        if anchor is None or anchor % every:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), i is None, i or 0, label) for b, (i, y, label) in enumerate(usable)
                         if a != b and len(x) == len(y)))
        scored = [(-s, None if absent else i, label) for s, absent, i, label in scored]
        for p, i, _ in [r for r in scored if r[2] == own][:positives]:
            fits = [(s, j) for s, j, label in scored if label != own and 30 * p <= 100 * s <= 90 * p]
            out.extend((anchor, i, k + 1, j, p, s) for k, (s, j) in enumerate(fits[:negatives]))
    return sorted(map(str, out))


def mined(spark, rows, every, **kw):
    frame = spark.createDataFrame([(i, v, label, "x", 1, "y", "z") for i, v, label in rows], SCHEMA).repartition(3)
    return sorted(str(tuple(r)) for r in m.mine(m.quantised(frame), F.col("vec_id") % every == 0, **kw).collect())


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(m, "LEAST_BLOCK", 16)
    monkeypatch.setattr(m, "BLOCK_VALUES", 64)


def test_by_brute_force(spark, small_blocks):
    draw = random.Random(4)
    rows = [(i, [draw.choice([-1.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(5)], draw.randrange(3)) for i in range(260)]
    # Ties and repeated rows, also of anchors; one id with different vectors; nulls, other lengths and empty vectors.
    rows += rows[:30] + [rows[10]] * 40 + [(20, [1.0] * 5, 1), (20, [1.0] * 5, 2), (None, [1.0] * 5, 1), (None, [1.0] * 5, 0)]
    rows += [(400, None, 1), (401, [1.0, None, 0.0, 0.0, 0.0], 1), (410, [float("nan")] * 5, 1), (420, [float("inf")] * 5, 1),
             (430, [1.0] * 5, None), (440, [1.0, 0.5], 1), (441, [1.0, 0.25], 0), (442, [1.0, 0.5], 1), (450, [], 1), (451, [], 0),
             (452, [], 1), (-10, [0.5] * 5, 1)]
    got = mined(spark, rows, 10)
    assert got == plainly(rows, 10) and len(got) > 1000


def test_hot_label_and_small_limits(spark, small_blocks):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(8)], 0 if i % 3 else draw.randrange(4)) for i in range(300)]
    assert mined(spark, rows, 20, positives=2, negatives=3) == plainly(rows, 20, 2, 3)


def test_few_rows(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(1, [1.0], 0)], 10) == []
    assert mined(spark, [(0, [1.0], 0), (1, [1.0], 0), (2, [0.5], 1)], 10) == ["(0, 1, 1, 2, 65536, 32768)"]


def test_scores_are_exact():
    x, e = np.array([[1 << 40, 3], [-(1 << 62), 1 << 62]]), np.array([[1 << 40, 1], [1 << 10, -7]])
    want = [[max(-m.MOST, min(m.MOST, sum(int(p) * int(q) for p, q in zip(a, b)))) for b in e] for a in x]
    assert m.inner_products(x, e).tolist() == want
    assert m.inner_products(x[:1, 1:] << 40, e[:, 1:]).tolist() == [[3 << 40, -21 << 40]]


def test_keys_sort_as_pairs():
    ids, scores = np.array([5, -5, 0, 7, 5]), np.array([9, 9, -3, m.MOST, -m.MOST])
    keys = m.pack(12, scores, 0, ids, np.array([0, 0, 1, 0, 0]), np.arange(5))
    order = sorted(range(5), key=lambda k: keys[k].tobytes())
    assert order == [3, 1, 0, 2, 4]
    assert [m.unpack(keys[k].tobytes()) for k in order] == [(12, 0, m.MOST, 7), (12, 0, 9, -5), (12, 0, 9, 5), (12, 0, -3, None),
                                                            (12, 0, -m.MOST, 5)]
