import hashlib
import re

import pytest

from basketlens.llm import fill_middle as m

SCHEMA = "doc_id LONG, text STRING, n STRING, form INT, id STRING, output STRING"
TEXTS = ["", None, "a", "é", "word", "two words", "a1b2 c3\n\tÜber straße 😀😀x 中文字 end.", "has <P> inside", "x<S", "<", "S>", "<<M", "P>",
         "same text", "same text", " ", "z" * 70_000, "é" * 3_000, "ab " * 40_000 + "😀", ("lorem ipsum, " * 300 + "ÄÖ\r\n") * 8]


def plainly(doc_id, text):
    """The contract by lists of units."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, mid, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(mid), f"<S>{s}<P>{p}<M>{mid}"
    return n, "psm", len(p), len(mid), f"<P>{p}<S>{s}<M>{mid}"


@pytest.fixture(scope="module")
def made(spark):
    rows = [(k * 7 + shift, t) for shift in range(12) for k, t in enumerate(TEXTS)] + [(None, "no id at all"), (5, "again"), (5, "again")]
    frame = spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in rows], SCHEMA).repartition(5)
    out = m.transform(frame)
    restored = m.restore(out["output"], out["form"])
    return rows, out.withColumn("restored", restored).collect()


def test_every_row_by_brute_force(made):
    rows, found = made
    got = sorted(map(repr, ((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in found)))
    assert got == sorted(map(repr, ((i, *plainly(i, t)) for i, t in rows)))


def test_round_trip_and_all_forms(made):
    rows, found = made
    assert sorted((str(r["doc_id"]), r["restored"]) for r in found) == sorted((str(i), t or "") for i, t in rows)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_no_rows_and_columns(spark):
    empty = m.transform(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"] and empty.count() == 0


def test_markers(spark):
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<<", "<S>", "<M>")):
        with pytest.raises(ValueError):
            m.check_markers(bad)
    marks = ("[pre]", "[suf]", "[mid]")
    frame = spark.createDataFrame([(i, "any text, cut (somewhere) [here]") for i in range(40)], "doc_id LONG, text STRING")
    out = m.transform(frame, markers=marks, plain_from=100, spm_below=50)
    rows = out.select("form", m.restore(out["output"], out["form"], marks).alias("t")).collect()
    assert {r["form"] for r in rows} == {"psm", "spm"} and {r["t"] for r in rows} == {"any text, cut (somewhere) [here]"}


def test_boundaries_lie_where_the_units_are():
    import numpy as np
    text = ("ab, é😀 " * 400).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    blocks = m.Blocks(m.unit_starts(data, offsets), (data & 0xC0) != 0x80)
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text.decode())
    for k in (0, 1, 5, 300, len(units) - 1, len(units)):
        before = "".join(units[:k])
        assert blocks.place(k) == (len(before.encode()), len(before))
