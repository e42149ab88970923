"""What is written on the way is narrow, and deleted when nothing reads it any more."""

import functools
import os
import time

import pytest
from pyspark.sql import functions as F

from basketlens import config
from basketlens.operators import correlation, features, normality, segment, skew
from basketlens.plans import quality_queries, segment_queries, statistics_queries
from basketlens.sources import staging


def tables(spark):
    folder = f"{staging.shared_folder(spark)}/tables".removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in folders for _, _, files in os.walk(top.getPath()) for f in files if f.startswith("shuffle_") and f.endswith(".data")}


def written(monkeypatch):
    """The columns of each table that is written from now on."""
    seen, write = [], staging.materialize

    def noted(df, *how, **named):
        seen.append(list(df.columns))
        return write(df, *how, **named)

    for module in (staging, skew, normality, correlation):
        monkeypatch.setattr(module, "materialize", noted)
    monkeypatch.setattr("basketlens.plans.sales_view.materialize", noted)
    return seen


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(300).select(F.pmod(F.col("id") * 7, F.lit(11)).cast("double").alias("age"), (F.col("id") * 1.5).alias("amount"),
                                   F.sqrt(F.col("id") + 1).alias("gross_amount")).localCheckpoint()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of a few rows with the columns that the sales view reads."""
    at = str(tmp_path_factory.mktemp("tables"))
    ids = spark.range(400)
    frames = {
        "customer": spark.range(20).selectExpr("id + 51 AS c_custkey", "concat('C', id) AS c_name", "'AUTO' AS c_mktsegment"),
        "orders": spark.range(100).selectExpr("id + 1 AS o_orderkey", "id % 20 + 51 AS o_custkey"),
        "part": spark.range(30).selectExpr("id + 1 AS p_partkey", "concat('P', id) AS p_name"),
        "lineitem": ids.selectExpr("id % 100 + 1 AS l_orderkey", "id % 30 + 1 AS l_partkey", "id % 7 + 1 AS l_suppkey",
                                   "CAST(id DIV 100 + 1 AS INT) AS l_linenumber", "CAST(id % 9 + 1 AS DOUBLE) AS l_quantity",
                                   "CAST(id % 83 + 10 AS DOUBLE) AS l_extendedprice", "id % 5 / 100.0D AS l_discount", "'O' AS l_linestatus",
                                   "timestampadd(DAY, CAST(id % 50 AS INT), TIMESTAMP '1998-01-01 00:00:00') AS l_shipdate")}
    for name, frame in frames.items():
        frame.write.parquet(f"{at}/{name}.parquet")
    return at


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(staging.DELETE_SHUFFLES, None)
    table = staging.materialize(spark.range(1000).repartition(3, "id"), compact=True)
    for _ in range(50):  # the executors are told, not waited for
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and table.count() == 1000
    assert spark.conf.get(staging.DELETE_SHUFFLES, None) == setting


def test_temporary_tables_are_deleted_but_for_those_kept(spark):
    before = tables(spark)
    with staging.temporary(spark) as keep:
        kept, gone = keep(staging.materialize(spark.range(3))), staging.materialize(spark.range(4))
        assert kept.count() + gone.count() == 7
    assert len(tables(spark) - before) == 1 and kept.count() == 3
    staging.discard(kept)
    assert tables(spark) == before


def test_blocks_write_no_sort_key_and_leave_only_their_sums(spark, numbers, monkeypatch):
    before, seen = tables(spark), written(monkeypatch)
    found = normality.normality_blocks(numbers, ["age", "amount"], 100)
    assert {(r["variable"], r["n"]) for r in found.collect()} == {("age", 100), ("amount", 100)}
    assert not any("_key" in columns for columns in seen)
    assert len(tables(spark) - before) == 1


@pytest.mark.parametrize("few", [0, 20_000])
def test_rank_correlations_leave_no_tables(spark, numbers, monkeypatch, few):
    monkeypatch.setattr(correlation, "LOOKUP_VALUES", few)
    before, pairs = tables(spark), correlation.all_pairs(["age", "amount", "gross_amount"])
    found = {(r["var1"], r["var2"]): r["corr"] for r in correlation.spearman_pairs(numbers, pairs).collect()}
    assert tables(spark) == before
    assert found["amount", "gross_amount"] == pytest.approx(1) and found["age", "amount"] == pytest.approx(found["age", "gross_amount"])


def test_features_keep_their_places_when_the_frequency_is_joined_first(spark):
    lines = spark.createDataFrame([("a", 1, 10.0, 2.0), ("a", 2, 20.0, 4.0), (None, 3, 30.0, 5.0)],
                                  "customer_id STRING, receipt_id BIGINT, amount DOUBLE, units DOUBLE")
    found = features.derive_features(lines, ["amount_per_unit", "purchase_freq"])
    assert found.columns == [*lines.columns, "amount_per_unit", "purchase_freq"]
    assert {(r["receipt_id"], r["amount_per_unit"], r["purchase_freq"]) for r in found.collect()} == {(1, 5.0, 2), (2, 5.0, 2), (3, 6.0, None)}


def test_derived_pairs_write_only_what_they_need_and_delete_it(spark, folder, monkeypatch):
    before, seen = tables(spark), written(monkeypatch)
    assert statistics_queries.derived_pairs(spark, folder).count() == len(config.DERIVED_PAIRS)
    assert not any({"product", "status", "first_name", "customer_run"} & set(columns) for columns in seen)
    left = [spark.read.parquet(f"{staging.shared_folder(spark)}/tables/{t}").columns for t in tables(spark) - before]
    # The derived lines, which the boxes' counts read, and the sums of blocks.
    assert ["amount", *config.DERIVED] in left and len(left) == 2


def test_null_policy_derived_leaves_one_narrow_table(spark, folder, monkeypatch):
    before, seen = tables(spark), written(monkeypatch)
    found = quality_queries.null_policy_derived(spark, folder)
    assert found.count() and found.columns == ["receipt_id", *config.DERIVED]
    assert not any({"product", "status", "first_name", "customer_run"} & set(columns) for columns in seen)
    left = [spark.read.parquet(f"{staging.shared_folder(spark)}/tables/{t}").columns for t in tables(spark) - before]
    assert left == [["receipt_id", *config.DERIVED]]


def test_segment_customers_leaves_only_the_scaled_customers(spark, folder, monkeypatch):
    before = tables(spark)
    # One fit instead of seventy.
    monkeypatch.setattr(segment, "segment_customers", functools.partial(segment.segment_customers, starts=1, ks=(3,)))
    profile = segment_queries.segment_customers(spark, folder)
    assert sum(r["size"] for r in profile.collect()) > 3
    left = [set(spark.read.parquet(f"{staging.shared_folder(spark)}/tables/{t}").columns) for t in tables(spark) - before]
    # The profile's medians keep a table of brackets, one row for each cluster and feature.
    assert [columns for columns in left if "purchase_count_z" in columns] and len(left) == 2
