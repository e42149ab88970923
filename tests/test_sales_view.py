import datetime

import pytest

from basketlens.plans import sales_view


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Every key repeats, is null or has no partner somewhere."""
    path = str(tmp_path_factory.mktemp("sales"))
    day = datetime.datetime(1995, 3, 1)
    lines = [(o, p, (p or 4) % 7, n, 3.0 + n, 100.0 * (p or 1), 0.05, "O", day) for o in (1, 2, 3, 41, 97, 5, None) for p in (10, 11, 205, 99, None) for n in (1, 2)]
    tables = {
        "lineitem": (lines + lines[:3], "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber BIGINT, l_quantity DOUBLE, "
                     "l_extendedprice DOUBLE, l_discount DOUBLE, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
        "orders": ([(1, 8), (2, 29), (2, 3), (3, 50), (41, 9), (97, 77), (5, None), (None, 8)], "o_orderkey BIGINT, o_custkey BIGINT"),
        "customer": ([(8, "c8", "X"), (29, "c29", None), (3, "c3", "Y"), (3, "c3b", "Z"), (50, None, "X"), (9, "c9", "Y"), (None, "c", "X")],
                     "c_custkey BIGINT, c_name STRING, c_mktsegment STRING"),
        "part": ([(10, "ten"), (11, None), (205, "a"), (205, "b"), (None, "none")], "p_partkey BIGINT, p_name STRING")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_rows_of_the_statement(spark, folder):
    frames = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in sales_view.TABLES}
    query = sales_view.SALES_SQL
    for t in sales_view.TABLES:
        query = query.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    wanted, found = spark.sql(query, **frames), sales_view.sales(spark, folder)
    assert found.schema == wanted.schema and found.count() > 20
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_lines_meet_narrow_tables(spark, folder):
    """Lines are moved for two joins only, and never together with a customer's texts."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sales_view.sales(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    lines = plan.splitlines()
    joins = [i for i, line in enumerate(lines) if "Join Inner" in line]
    assert len(joins) == 3 and plan.index("md5(") < plan.index("Join Inner")
    # The join of orders and customers lies beside the lines, not on them.
    lineitem = next(i for i, line in enumerate(lines) if "l_orderkey" in line and "Relation" in line)
    assert sum(i < lineitem for i in joins) == 2


def test_customers_read_the_lines_once(spark, folder):
    plan = sales_view.customers(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan
