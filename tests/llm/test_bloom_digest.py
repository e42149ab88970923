import hashlib
import random

import numpy as np
import pytest

from basketlens.llm import bloom_digest as m

SCHEMA = "doc_id LONG, text STRING, part STRING"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(6)
    syllables = ["the", "an", "tion", "ß", "éa", "or", "in", "sh", "wh", "ea"]
    out = [(7 * k, " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(draw.choice([1, 8, 60, 900])))) for k in range(60)]
    return out + [(1, ""), (2, None), (3, "ab"), (5, "a" * 5000), (6, "😀" * 90)]


def test_against_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(7)
    information = m.byte_information(docs)
    ordered = sorted(rows, key=lambda r: -r[0])
    got = {r["doc_id"]: tuple(r) for r in m.compare_with_next(docs).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        changed = m.edited(text, after)
        f, g, h = (m.fingerprint(x, information) for x in (text, changed, after))
        assert got[i] == (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), m.write_digest(f), m.write_digest(g),
                          m.likeness(f, g), m.likeness(f, h))


def test_pair_counts(spark):
    docs = spark.createDataFrame([(1, "aab", "x"), (2, "b", "x"), (3, None, "x"), (4, "ab", "x")], SCHEMA)
    information = m.byte_information(docs)
    after_a = np.array([0.5] * 256)
    after_a[ord("a")] += 1
    after_a[ord("b")] += 2
    want = np.round(-np.log(after_a / after_a.sum()) * m.SCALE)
    assert (information.reshape(256, 256)[ord("a")] == want).all()


def test_highest_within_reach():
    x = np.random.default_rng(1).integers(0, 50, 300).astype(np.uint64)
    for reach in (1, 5, 10, 33):
        assert (m._highest(x, reach) == [x[max(0, i - reach):i + reach + 1].max() for i in range(300)]).all()


def test_likeness(rows):
    information = np.random.default_rng(2).integers(0, 3000, 65536).astype(np.int32)
    texts = [t for _, t in rows if t and len(t) > 2000]
    for one, two in zip(texts, texts[1:]):
        f, g = m.fingerprint(one, information), m.fingerprint(two, information)
        near = m.fingerprint(m.edited(one, two), information)
        assert m.likeness(f, f) == 1.0 and m.likeness(f, near) > 0.4 > m.likeness(f, g) >= 0.0
        again = m.read_digest(m.write_digest(f))
        assert (again[0] == f[0]).all() and (again[1] == f[1]).all()
    empty = m.fingerprint("", information)
    assert m.likeness(empty, empty) == 1.0 and m.likeness(empty, m.fingerprint("x", information)) == 0.0


def test_copies_ties_and_single_rows(spark):
    docs = spark.createDataFrame([(3, "same text of some length", "x")] * 5 + [(None, "x", "x")], SCHEMA).repartition(3)
    got = m.compare_with_next(docs).collect()
    assert len(got) == 6 and len({r["fingerprint"] for r in got if r["doc_id"] == 3}) == 1
    alone = m.compare_with_next(docs.where("doc_id is null")).collect()
    assert [(r["n_chars"], r["near_next"]) for r in alone] == [(1, 1.0)]
    assert m.compare_with_next(docs.limit(0)).count() == 0


# ---- the digest by plain loops, sharing only the constants -------------------------------

def plain_hash(window):
    """The polynomial of a window's bytes, scrambled."""
    full, base = (1 << 64) - 1, 0x9E3779B97F4A7C15 | 1
    x = sum((b + 1) * pow(base, k, 1 << 64) for k, b in enumerate(window)) & full
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & full
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & full
    return x ^ (x >> 31)


def plain_filters(text, information):
    """(number of windows, set of bits) of each filter of a text."""
    data = text.encode()
    if not data:
        return []
    if len(data) < m.SHORT_TEXT:
        chosen = [data[k:k + m.SHORT_WINDOW] for k in range(max(1, len(data) - m.SHORT_WINDOW + 1))]
    else:
        ranks = []
        for k in range(len(data) - m.WINDOW + 1):
            w = data[k:k + m.WINDOW]
            rare = sum(int(information[a * 256 + b]) for a, b in zip(w, w[1:]))
            ranks.append((rare, (w[0] * 0x9E37 + w[-1] * 0x85EB) & 0xFFFF))
        chosen = [data[k:k + m.WINDOW] for k, r in enumerate(ranks) if r == max(ranks[max(0, k - m.REACH):k + m.REACH + 1])]
    kept = [w for k, w in enumerate(chosen) if not k or plain_hash(w) != plain_hash(chosen[k - 1])]
    out = []
    for low in range(0, len(kept), m.FILTER_FEATURES):
        some = kept[low:low + m.FILTER_FEATURES]
        out.append((len(some), {(plain_hash(w) >> (11 * k)) % m.FILTER_BITS for w in some for k in range(m.HASHES)}))
    return out


def plain_likeness(one, two):
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    if len(one) > len(two):
        one, two = two, one
    total = 0.0
    for n, bits in one:
        best = 0.0
        for _, other in two:
            chance, most = len(bits) * len(other) / m.FILTER_BITS, min(len(bits), len(other))
            best = max(best, min(1.0, max(0.0, (len(bits & other) - chance) / max(most - chance, 1e-9))))
        total += n * best
    return total / sum(n for n, _ in one)


def test_digest_by_plain_loops(rows):
    information = np.random.default_rng(4).integers(0, 3000, 65536).astype(np.int32)
    texts = [t or "" for _, t in rows][:24] + ["", "ab", "a" * 300, "short text", "😀" * 40]
    plain, ours = [plain_filters(t, information) for t in texts], [m.fingerprint(t, information) for t in texts]
    for p, (counts, bits) in zip(plain, ours):
        assert [n for n, _ in p] == counts.tolist()
        assert [sorted(b) for _, b in p] == [np.flatnonzero(np.unpackbits(row)).tolist() for row in bits]
    for k in range(len(texts) - 1):
        assert m.likeness(ours[k], ours[k + 1]) == pytest.approx(plain_likeness(plain[k], plain[k + 1]), abs=1e-12)
