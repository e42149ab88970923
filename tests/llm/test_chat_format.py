import hashlib
import random

import pytest
from pyspark.sql import functions as F

from basketlens.llm import chat_format as m

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, window INT, position STRING"


def digests(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def hostile(n, seed=3):
    draw = random.Random(seed)
    bits = ["\\", "#", "<", "### user\n", "</turn>", "\n", "é😀", "word ", "\n</turn>\n", "\r\n", " "]
    return [(draw.choice([1, 2, None]), draw.choice([k, k // 2, None]),
             draw.choice(["user", "assistant", "system", None, "we#ird\n\\role:"]),
             draw.choice([None, "", "".join(draw.choice(bits) for _ in range(draw.choice([3, 50, 900])))])) for k in range(n)]


@pytest.fixture(scope="module")
def long_talk(spark):
    draw = random.Random(5)
    rows = [(9, 0, "system", "be kind " * 20)]
    rows += [(9, 1 + k, "assistant" if k % 2 else "user", f"turn {k} " * draw.choice([5, 30, 200])) for k in range(80)]
    return rows, m.format_windows(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)).cache()


def test_turns_and_targets_read_back(spark):
    rows = hostile(200) + [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    rows += [(3, 0, "user", "same")] * 3
    windows = m.format_windows(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4))
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
             for r in m.conversation_digests(windows).collect()}
    assert found == digests(rows)


def test_windows_keep_the_budget_and_repeat_history(long_talk):
    rows, windows = long_talk
    got = windows.orderBy("window").collect()
    assert len(got) > 5
    for w in got:
        assert w["tokens"] <= m.BUDGET or w["n_turns"] - w["n_repeated"] == 1
        assert w["text"].startswith("### system\nbe kind")  # the system turn is in every window
    assert all(w["n_repeated"] >= 1 for w in got[1:]) and any(w["n_repeated"] > 1 for w in got)


def test_repeated_targets_are_masked(long_talk):
    rows, windows = long_talk
    spans = sum(len(w["loss_spans"]) for w in windows.collect())
    assert spans == sum(r[2] == "assistant" for r in rows)
    for w in windows.collect():
        for s in w["loss_spans"]:
            assert w["text"][s["start"]:s["end"]].startswith("turn ") and w["text"][s["end"]:].startswith(m.TAIL)


def test_long_turn_stays_whole_and_empty_table(spark):
    text = "word " * 5000
    one = m.format_windows(spark.createDataFrame([(1, 0, "user", text, 1, "x")], SCHEMA)).collect()
    assert len(one) == 1 and text in one[0]["text"]
    assert m.format_windows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(long_talk):
    plan = long_talk[1].select(F.col("text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
