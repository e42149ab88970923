"""Registered queries against their SQL on the small tables (tools/check_queries.py runs all)."""

import glob
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as entry  # noqa: E402
from basketlens import config  # noqa: E402
from basketlens.plans.sales_view import valid  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
CHECKED = ["null_profile", "rule_violations", "validate_base", "iqr_two_pass", "null_policy", "derive_features",
           "full_stats_base", "spearman_pairs", "chi2_blocks", "anova_oneway", "tukey_hsd", "histogram", "box_stats",
           "customer_table", "cluster_interpretation", "clustering_metrics_fixed", "kmeans_elbow_checks", "kmeans_assign_checks"]


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
def test_entry(spark):
    assert entry.entry(spark).count() == 17


@pytest.fixture(scope="module")
def tables():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
def test_approximate_quantiles_by_rank(spark):
    found = entry.queries()["quantiles_approx"](spark, FOLDER).collect()
    assert len(found) == len(config.NUMERIC) * 5
    rows = valid(spark, FOLDER).select(config.NUMERIC).toPandas()
    for r in found:
        x = rows[r["variable"]].dropna().astype(float)
        below, upto = (x < r["quantile"]).mean(), (x <= r["quantile"]).mean()
        assert below - 0.001 <= r["probability"] <= upto + 0.001


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
def test_gated_tukey(spark):
    queries = entry.queries()
    passed = {r["factor"] for r in queries["anova_pvalues"](spark, FOLDER).collect() if r["pvalue"] <= config.ALPHA}
    pairs = lambda name: {(r["factor"], r["group1"], r["group2"]) for r in queries[name](spark, FOLDER).collect()}
    assert pairs("tukey_gated") == {p for p in pairs("tukey_pvalues") if p[0] in passed}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, tables, name):
    from check_queries import compare
    found = entry.queries()[name](spark, FOLDER).toPandas()
    assert compare(found, tables.execute(entry.oracle_sql()[name]).df()) is None
