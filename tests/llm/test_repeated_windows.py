import hashlib
import random
import re

import numpy as np
import pytest

from basketlens.llm import repeated_windows as m, textbytes

SCHEMA = "doc_id LONG, text STRING, k1 STRING, first INT, n_words STRING, places STRING"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def plainly(rows, length):
    """Every window of every row in a dictionary."""
    out = []
    found = [(i, words(t)) for i, t in rows]

    def firsts(size):
        least = {}
        for i, w in found:
            for k in range(len(w) - size + 1):
                if i is not None:
                    key = tuple(w[k:k + size])
                    least[key] = min(least.get(key, i), i)
        return least

    levels = {}
    size = length
    while size <= max((len(w) for _, w in found), default=0):
        levels[size] = firsts(size)
        size *= 2
    for i, w in found:
        gone, longest = set(), 0
        for size, least in levels.items():
            for k in range(len(w) - size + 1):
                if i is not None and least[tuple(w[k:k + size])] < i:
                    longest = max(longest, size)
                    if size == length:
                        gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), longest))
    return sorted(map(str, out))


def found(spark, rows, length):
    frame = spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in rows], SCHEMA).repartition(4)
    return sorted(str(tuple(r)) for r in m.without_repeats(frame, length).collect())


def corpus(seed, length):
    draw = random.Random(seed)
    vocabulary = ["le", "la", "Ünï", "中", "a", "the", "x.", "y,"] + [f"w{k}" for k in range(60)]
    text = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    shared = [text(draw.randrange(length - 1, 5 * length)) for _ in range(6)]
    rows = []
    for i in range(70):
        w = text(draw.randrange(0, 4 * length))
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(w) + 1)
            w[at:at] = draw.choice(shared)
        rows.append((draw.randrange(200), draw.choice([" ", "\n", "\t "]).join(w)))
    rows += [(draw.randrange(200), rows[draw.randrange(70)][1]) for _ in range(30)]
    # Copies, also under one id; no id; repetitions inside one text; nulls and empty texts.
    rows += [(500, rows[3][1])] * 3 + [(None, rows[3][1]), (None, rows[4][1]), (600, None), (601, ""), (602, " \n ")]
    rows += [(700, "again " * 6 * length), (701, "again " * 3 * length), (702, "u v " * 4 * length), (699, "v u " * 4 * length)]
    return rows


@pytest.mark.parametrize("length", [2, 5, 8])
def test_by_brute_force(spark, length):
    rows = corpus(length, length)
    assert found(spark, rows, length) == plainly(rows, length)


def test_whole_length_and_passage_of_most(spark):
    draw = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, " ".join(f"u{draw.randrange(10 ** 6)}" for _ in range(30)) + " " + passage + f" end{i}") for i in range(300)]
    rows += [(1000, rows[5][1]), (1001, passage[:-3]), (1002, " ".join(passage.split()[:49]))]
    got = found(spark, rows, 50)
    assert got == plainly(rows, 50)
    assert sum("', 50)" in r for r in got) > 290


def test_long_text(spark):
    draw = random.Random(3)
    long = " ".join(f"t{draw.randrange(50)}" for _ in range(60_000))
    rows = [(1, long), (2, "start " + long), (3, long[:2_000])]
    assert found(spark, rows, 50)[0].startswith("(1, 60000, 0")
    got = {r.doc_id: r for r in m.without_repeats(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()}
    assert got[2].n_removed == 60_000 and got[2].kept_sha256 == hashlib.sha256(b"start").hexdigest() and got[2].longest == 51_200


def test_nothing(spark):
    assert found(spark, [], 50) == []
    assert found(spark, [(1, None)], 50) == plainly([(1, None)], 50)


def test_words_that_sums_modulo_a_power_of_two_mistake(spark):
    """Complementary Thue-Morse words; and keys don't depend on where a span lies, also beyond a block."""
    def morse(n, swap):
        return "".join("ab"[(bin(k).count("1") + swap) % 2] for k in range(n))

    for n in (512, 1024, 4096):
        data = np.frombuffer((morse(n, 0) + morse(n, 1) + morse(n, 0)).encode(), np.uint8)
        a, b = textbytes.span_keys(data, np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]))
        assert a[0] == a[2] != a[1] and b[0] == b[2] != b[1]
    data = np.tile(np.arange(251, dtype=np.uint8), 9_000)
    at = np.array([0, 251 * 5_000, 251 * 8_000])
    a, b = textbytes.span_keys(data, at, at + 251 * 900)
    assert len(set(a.tolist())) == 1 and len(set(b.tolist())) == 1
    rows = [(1, " ".join([morse(2048, 0)] * 3)), (2, " ".join([morse(2048, 1)] * 3))]
    assert found(spark, rows, 2) == plainly(rows, 2)
