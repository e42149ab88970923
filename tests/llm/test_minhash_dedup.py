import math
import random
from fractions import Fraction

import numpy as np
import pytest

from basketlens.llm import minhash_dedup as m
from basketlens.llm.components import components

SCHEMA = "doc_id LONG, text STRING, class STRING, label INT"


def brute(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * i >= 75 * (len(sets[a]) + len(sets[b]) - i):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    out = []
    for k, (i, _) in enumerate(rows):
        c = least.get(find(k)) if sets[k] else i
        out.append((i, len(sets[k]), c, i == c))
    return out


def found(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)
    return [tuple(r)[:4] for r in m.near_duplicates(docs).collect()]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(2)
    words = [f"w{k}" for k in range(400)]
    out = []
    for group in range(12):
        base = [draw.choice(words) for _ in range(draw.choice([6, 30, 200]))]
        for copy in range(draw.choice([1, 3, 25])):
            text = list(base)
            for _ in range(draw.choice([0, 1, 2, 4, 8])):
                text[draw.randrange(len(text))] = draw.choice(words)
            out.append(" ".join(text))
    out += ["", None, "  \n\t", "one two", "One\ttwo", "one two three", "É é a b c d", "é é a b c d", out[0], out[0].upper(), "a\x0bb\x0cc d e f"]
    draw.shuffle(out)
    return [(None if k % 41 == 7 else 3 * k, t) for k, t in enumerate(out)] + [(0, out[0]), (0, "other words that are there once only")]


def test_against_brute_force(spark, rows):
    key = lambda x: str(x)
    assert sorted(found(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_dense_groups_and_blocks(spark, rows, monkeypatch):
    """Small blocks and no room for pairs, so that members meet across blocks with their full sets."""
    monkeypatch.setattr(m, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(m, "SET_BLOCK_MEMBERS", 4)
    monkeypatch.setattr(m, "PAIRS_PER_MEMBER", 0)
    key = lambda x: str(x)
    assert sorted(found(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_posterior_bounds():
    """The thresholds against the posterior integrated in exact arithmetic."""
    t, needed = Fraction(3, 4), m.needed_matches()
    for n, least in zip(range(m.BATCH, m.HASHES + 1, m.BATCH), needed):
        def tail(k):
            # Beta(k+1, n-k+1) beyond t, expanded by the binomial theorem.
            scale = math.factorial(n + 1) // (math.factorial(k) * math.factorial(n - k))
            return scale * sum(Fraction((-1) ** j * math.comb(n - k, j), k + j + 1) * (1 - t ** (k + j + 1)) for j in range(n - k + 1))
        assert tail(least) >= m.MISS_PROBABILITY > tail(least - 1)


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(4)
    a = draw.integers(0, 2**63, 2000).astype(np.uint64)
    b = np.concatenate([a[:1500], draw.integers(0, 2**63, 500).astype(np.uint64)])
    sig = m.signatures(np.concatenate([a, b]), np.array([0, 2000, 4000]))
    assert abs((sig[0] == sig[1]).mean() - 1500 / 2500) < 0.15


def test_empty_table(spark):
    assert found(spark, [(1, "x")])[0] == (1, 1, 1, True)
    assert m.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(7, 7), (300, 299)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a LONG, b LONG")).collect()}
    want = {k: 0 for k in range(1, 41)} | {200 + k: 100 for k in range(50)} | {300: 299}
    assert {k: v for k, v in got.items() if k != v} == want


def test_words_that_sums_modulo_a_power_of_two_mistake(spark):
    """Complementary Thue-Morse words share nothing: alone, and as one word of several."""
    def morse(n, swap):
        return "".join("ab"[(bin(k).count("1") + swap) % 2] for k in range(n))

    rows = []
    for n in (1024, 4096):
        rows += [(len(rows) + k, t) for k, t in enumerate([morse(n, 0), morse(n, 1), f"x {morse(n, 0)}", f"x {morse(n, 1)}", morse(n, 0).upper()])]
    assert sorted(found(spark, rows)) == sorted(brute(rows))


def test_sets_with_keys_equal_in_one_lane():
    a = np.array([5, 5, 5, 7, 7, 9], np.uint64)
    b = np.array([2, 1, 2, 3, 3, 4], np.uint64)
    one = m.distinct_keys(a, b)
    assert one.tolist() == [[5, 1], [5, 2], [7, 3], [9, 4]]
    two = m.distinct_keys(np.array([5, 7, 9, 11, 12], np.uint64), np.array([2, 3, 5, 1, 1], np.uint64))
    assert m.shared_keys(one, two) == m.shared_keys(two, one) == 2
    assert m.numbered(np.concatenate([one, two])).tolist() == [0, 1, 2, 3, 1, 2, 4, 5, 6]


def test_members_are_joined_once_and_dealt_with_what_they_bring(spark):
    rows = [(7, 10, c, c, bytes([c])) for c in range(10)] + [(8, 2, c, c, bytes([c])) for c in (3, 4)]
    members = spark.createDataFrame(rows, "bucket LONG, size LONG, class LONG, label LONG, signature BINARY")
    dealt = m._dealt(members, 4, "signature").collect()
    assert all(bytes(r["signature"]) == bytes([r["class"]]) for r in dealt)
    # Ten members in three blocks: each pair meets in one task, in the other tasks on the same side.
    for bucket, classes in ((7, range(10)), (8, (3, 4))):
        for a in classes:
            for b in classes:
                if a < b:
                    sides = [{r["class"]: r["side"] for r in dealt if (r["bucket"], r["blocks"]) == (bucket, k)}
                             for k in {r["blocks"] for r in dealt if r["bucket"] == bucket}]
                    met = [s for s in sides if a in s and b in s and (s[a] == 0 or s[a] != s[b])]
                    assert len(met) == 1, (a, b)
    assert {(r["blocks"], r["side"]) for r in dealt if r["bucket"] == 8} == {(0, 0)}
