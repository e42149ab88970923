import math

import pytest
from pyspark.sql import functions as F

from basketlens.llm import source_mix as m

SCHEMA = "doc_id LONG, text STRING, source STRING, pass INT, key STRING"


@pytest.fixture(scope="module")
def docs(spark):
    sizes = {"big": 600, "mid": 120, "small": 30}
    rows = [(i, "w " * (5 + i % 7), s, 1, "k") for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def drawn(docs, plan):
    rows = docs.drop("pass")
    return m.mix(rows, plan).groupBy("source").agg(
        F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("tokens"), F.countDistinct("doc_id").alias("docs"),
        F.max("pass").alias("last")).toPandas().set_index("source")


def entropy(plan):
    return -sum(w * math.log(w) for w in plan.weight) / math.log(len(plan))


def test_target_entropy_and_quotas(docs):
    plan = m.plan_mix(docs, target_entropy=0.9, most_repeats=None, block_tokens=200)
    table = plan.toPandas()
    assert abs(entropy(table) - 0.9) < 1e-3 and abs(table.weight.sum() - 1) < 1e-9
    got = drawn(docs, plan)
    for r in table.itertuples():
        assert abs(got.tokens[r.source] - r.quota) <= 12  # one document


def test_repeats_limit_wins(docs):
    table = m.plan_mix(docs, target_entropy=1.0, most_repeats=2.0).toPandas()
    assert (table.quota / table.n).max() == pytest.approx(2.0, rel=1e-3)


def test_cover_keeps_every_document(docs):
    plan = m.plan_mix(docs, m.COVER, target_entropy=1.0, most_repeats=1.5, block_tokens=200)
    got = drawn(docs, plan)
    assert dict(got.docs) == {"big": 600, "mid": 120, "small": 30}
    table = plan.toPandas().set_index("source")
    assert (table.quota / table.n).max() == pytest.approx(1.5, rel=1e-3) and (table.quota / table.n).min() == pytest.approx(1.0)


def test_budget_and_nested_draws(docs):
    """A larger budget takes the same blocks and more."""
    less, more = ({(r["doc_id"], r["source"]) for r in m.mix(docs, m.plan_mix(docs, b, block_tokens=100)).collect()} for b in (800, 1600))
    assert less < more and len(less) < 160


def test_passes_are_permutations_of_blocks(docs):
    """Blocks are the same documents in every pass, in another order; the partial pass is the head of its order."""
    rows = m.mix(docs.drop("pass"), m.plan_mix(docs, block_tokens=100), order_names=("at", "place")).collect()
    blocks = {}
    for r in rows:
        blocks.setdefault((r["source"], r["pass"]), {}).setdefault(r["at"], set()).add(r["doc_id"])
    for source in {s for s, _ in blocks}:
        passes = [blocks[source, p] for p in range(max(p for s, p in blocks if s == source) + 1)]
        orders = [[frozenset(found[b]) for b in sorted(found)] for found in passes]
        for whole in orders[1:-1]:
            assert set(whole) == set(orders[0]) and (len(whole) < 3 or whole != orders[0])
        if len(orders) > 1:
            assert set(orders[-1][:-1]) <= set(orders[0]) and any(orders[-1][-1] <= b for b in orders[0])
    assert any(len(found) > 1 for found in blocks.values()) and len({p for _, p in blocks}) > 1


def test_odd_rows(spark):
    rows = [(1, "a b", "x", 1, "k")] * 3 + [(None, None, None, 1, "k"), (2, "", None, 1, "k"), (3, "z " * 5000, "y", 1, "k")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = m.mix(docs, m.plan_mix(docs, m.COVER, most_repeats=1.0), pass_name=None)
    assert got.columns == docs.columns and got.count() == len(rows)
    assert m.mix(docs.limit(0), m.plan_mix(docs.limit(0)), pass_name=None).count() == 0


def test_names_that_docs_has_already(spark, tmp_path):
    rows = [(i, "w " * (3 + i % 4), f"s{i % 3}", 1, 2, 3, 4) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, pass INT, block INT, place INT, Pass_ INT")
    got = m.mix(docs, m.plan_mix(docs, block_tokens=20), order_names=("block", "place"))
    assert got.columns == [*docs.columns, "pass__", "block_", "place_"] and got.count() > 0
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert m.op8(spark, str(tmp_path)).columns == ["doc_id", "source", "pass", "block", "place"]


def test_draws_by_a_plain_loop(spark):
    """The same (document, pass, block, place) by sorting every source's blocks and filling the quota in a loop."""
    rows = [(i, "w " * (1 + i * i % 9), ("big", "big", "big", "mid", "small")[i % 5]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")
    plan = m.plan_mix(docs, target_entropy=0.97, most_repeats=None, block_tokens=60)
    got = sorted(tuple(r) for r in m.mix(docs, plan, order_names=("block", "place")).select("doc_id", "pass", "block", "place").collect())
    planned = {r["source"]: r for r in plan.collect()}
    # The hashes are the definition of the orders; everything else is done here.
    hashed = docs.select("doc_id", "source", F.xxhash64("doc_id", "text", F.lit(42)).alias("key"),
                         F.regexp_count("text", F.lit(r"\S+")).alias("tokens"))
    want = []
    for source, p in planned.items():
        for k in range(p["passes"] + 1):
            block = F.pmod(F.col("key"), F.lit(p["blocks"]))
            placed = hashed.where(F.col("source") == source).select(
                "doc_id", "tokens", F.xxhash64(F.lit(42), F.lit(k).cast("long"), "source", block).alias("b"),
                F.xxhash64(F.lit(42), F.lit(k).cast("long"), "key").alias("p")).collect()
            left = p["rest"] if k == p["passes"] else math.inf
            for r in sorted(placed, key=lambda r: (r["b"], r["p"])):
                left -= r["tokens"]
                if left < 0:
                    break
                want.append((r["doc_id"], k, r["b"], r["p"]))
    assert got == sorted(want)
