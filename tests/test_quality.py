"""Rules, profiles, outliers and the null policy on literal rows."""

import pytest
from pyspark.sql import functions as F

from basketlens import config
from basketlens.functions import columns as C
from basketlens.operators import features, quality
from basketlens.sources import delimited
from basketlens.sources.staging import materialize


def values(df, c, order="id"):
    return [r[0] for r in df.orderBy(order).select(c).collect()]


def one_column(spark, rows, ddl):
    return spark.createDataFrame(list(enumerate(rows)), f"id INT, x {ddl}")


def test_numeric_coercion(spark):
    df = one_column(spark, ["1.5", " 2 ", "abc", "", None, "1d", "NaN", "1e3", "1,5"], "STRING")
    assert values(quality.coerce_numeric(df, ["x"]), "x") == [1.5, 2.0, None, None, None, None, None, 1000.0, None]


def test_timestamp_coercion(spark):
    df = one_column(spark, ["2024-02-29 10:00:00", "2024-02-30", "x", None], "STRING")
    found = values(quality.coerce_timestamps(df, ["x"]), "x")
    assert [f is None for f in found] == [False, True, True, True]


def test_rules_and_their_nulls(spark):
    df = one_column(spark, [-0.1, 0.0, 1.0, 1.1, None], "DOUBLE").select(
        "id", C.in_range(F.col("x"), 0, 1).alias("r"), C.in_domain(F.col("x"), [1.0]).alias("d"),
        C.in_domain_or(F.col("x"), [0.0], -1.0).alias("s"), C.at_least(F.col("x"), 1.0).alias("m"))
    assert values(df, "r") == [None, 0.0, 1.0, None, None]
    assert values(df, "d") == [None, None, 1.0, None, None]
    assert values(df, "s") == [-1.0, 0.0, -1.0, -1.0, -1.0]
    assert values(df, "m") == [1.0, 1.0, 1.0, 1.1, 1.0]


def test_pattern(spark):
    good = "9B72E31D-ac81-7154-66cd-580a448cf823"
    df = one_column(spark, [good, "sin-codigo", good + "0", None], "STRING")
    assert values(df.select("id", C.matching(F.col("x")).alias("x")), "x") == [good.lower(), None, None, None]


def test_violation_counts_treat_nulls_by_rule(spark):
    df = spark.createDataFrame([(1.5, 9.0, "x"), (None, None, None), (0.5, 1.0, "0" * 8 + "-0000" * 3 + "-" + "0" * 12)],
                               "discount_pct DOUBLE, gender DOUBLE, customer_id STRING")
    found = {r["rule"]: r["violations"] for r in quality.rule_violations(df).collect()}
    assert found == {"discount_pct_range": 1, "gender_domain": 2, "customer_id_pattern": 2}


def test_ieee_division(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0), (1, -1.0, 0.0), (2, 0.0, 0.0), (3, 1.0, 4.0), (4, None, 1.0)],
                               "id INT, a DOUBLE, b DOUBLE").withColumn("q", C.ieee_divide(F.col("a"), F.col("b")))
    assert values(df, "q") == [C.INF, -C.INF, None, 0.25, None]
    assert values(quality.replace_infinite(df, ["q"]), "q") == [None, None, None, 0.25, None]


def test_null_profile_duplicates_and_empty_frame(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "a")], "a INT, b STRING")
    assert {r["variable"]: (r["nulls"], r["pct"]) for r in quality.null_profile(df).collect()} == {
        "a": (0, 0.0), "b": (2, 40.0)}
    assert quality.duplicate_count(df).first()["duplicates"] == 3
    empty = df.limit(0)
    assert {r["pct"] for r in quality.null_profile(empty).collect()} == {0.0}
    assert quality.duplicate_count(empty).first()["duplicates"] == 0
    assert quality.apply_null_policy(empty, ["a", "b"]).count() == 0


def test_iqr(spark):
    df = spark.createDataFrame([(i, float(i), 1.0, None) for i in range(10)] + [(10, 1000.0, 1.0, None)],
                               "id INT, units DOUBLE, store DOUBLE, amount DOUBLE")
    assert set(quality.fit_iqr(df)) == {"units"}
    trimmed = quality.iqr_null_outliers(df)
    assert values(trimmed, "units") == [float(i) for i in range(10)] + [None]
    assert values(trimmed, "store") == [1.0] * 11
    found = quality.iqr_outlier_counts(df).first()
    assert (found["variable"], found["outliers"], found["pct"]) == ("units", 1, pytest.approx(100 / 11))


def test_policy_bounds_are_inclusive(spark):
    rows = [(i, None if i < 5 else 1.0, None if i < 20 else float(i), None if i < 21 else 1.0, 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "id INT, five DOUBLE, twenty DOUBLE, more DOUBLE, none DOUBLE")
    names = ["five", "twenty", "more", "none"]
    plan = {r["variable"]: r["action"] for r in quality.null_policy_plan(df, names).collect()}
    assert plan == {"five": "drop_rows", "twenty": "impute", "more": "drop_column", "none": "keep"}
    out = quality.apply_null_policy(df, names)
    assert out.columns == ["id", "five", "twenty", "none"]
    assert out.count() == 95 and out.na.drop().count() == 95


def test_imputed_value_sees_only_rows_left_by_earlier_columns(spark):
    # x is null for ids 0–9; y is null for the two largest x. Order decides which rows count.
    rows = [(i, None if i < 10 else float(i), None if i > 97 else 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "id INT, x DOUBLE, y DOUBLE")
    first = quality.apply_null_policy(df, ["x", "y"]).where("id = 0").first()["x"]
    later = quality.apply_null_policy(df, ["y", "x"]).where("id = 0").first()["x"]
    assert (first, later) == (54.5, 53.5)


def test_policy_imputes_text_and_booleans_with_the_mode(spark):
    rows = [(i, None if i < 2 else ("b" if i % 2 else "a"), None if i < 2 else i % 3 == 0) for i in range(20)]
    df = spark.createDataFrame(rows, "id INT, t STRING, f BOOLEAN")
    out = quality.apply_null_policy(df, ["t", "f"]).where("id = 0").first()
    assert (out["t"], out["f"]) == ("a", False)


def test_missingness_signal(spark):
    rows = [(None, 10.0)] * 10 + [(1.0, 20.0)] * 10
    df = spark.createDataFrame(rows, "units DOUBLE, amount DOUBLE")
    found = quality.missingness_mechanism(df).collect()
    assert [(r["target"], r["probe"], r["relative_difference"], r["not_mcar"]) for r in found] == [
        ("units", "amount", 0.5, True)]


def test_features(spark):
    rows = [("2024-01-06 23:00:00", "2000-05-05", 10.0, 0.0, 1.0, "c", 1), ("2024-01-07 22:00:00", None, 20.0, 2.0, 0.5, "c", 2),
            ("2024-01-07 23:00:00", "1980-01-01", 30.0, 3.0, None, None, 3), (None, None, None, None, 0.1, "d", None)]
    df = spark.createDataFrame(rows, "ts STRING, birth_date STRING, amount DOUBLE, units DOUBLE, discount_pct DOUBLE, "
                                     "customer_id STRING, receipt_id BIGINT")
    df = quality.coerce_timestamps(df).withColumn("id", F.monotonically_increasing_id())
    out = quality.validate_derived(features.derive_features(df))
    # 23 hours before the latest line is no full day, although the calendar day may differ.
    assert values(out, "recency_days") == [1.0, 0.0, 0.0, None]
    assert values(out, "is_weekend") == [True, True, True, False]
    assert values(out, "age") == [26.0, None, 46.0, None]
    assert values(out, "amount_per_unit") == [C.INF, 10.0, 10.0, None]
    assert values(out, "gross_amount") == [C.INF, 40.0, None, None]
    assert values(out, "purchase_freq") == [2.0, 2.0, 1.0, 1.0]
    assert values(out, "amount_segment") == ["Bajo", "Medio", "Alto", "Bajo"]


def test_features_skip_missing_inputs(spark):
    df = spark.createDataFrame([(1.0,)], "amount DOUBLE")
    assert features.derive_features(df).columns == ["amount", "amount_segment"]
    assert config.missing(df, ["amount", "units"]) == ["units"]


def test_scaling_and_its_stored_parameters(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(10)], "age DOUBLE, gross_amount DOUBLE")
    params = features.scaling_parameters(df)
    assert [r["column"] for r in params.collect()] == ["age"]
    delimited.write_parameters(params, str(tmp_path / "params"))
    again = features.apply_scaling(df, delimited.read_parameters(spark, str(tmp_path / "params")))
    moments = again.agg(F.avg("age_scaled").alias("m"), F.stddev_samp("age_scaled").alias("s")).first()
    assert (moments["m"], moments["s"]) == (pytest.approx(0), pytest.approx(1))


def test_delimited_round_trip(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("sku;units;amount;ts\n1;2;10.5;2024-01-01 10:00:00\n2;x;;not a date\n")
    df = delimited.scan_delimited(spark, str(path), ["sku", "units", "amount", "ts"])
    assert {t for _, t in df.dtypes} == {"string"}
    rows = quality.validate_base(df).orderBy("sku").collect()
    assert [(r["sku"], r["units"], r["amount"], r["ts"] is None) for r in rows] == [
        (1.0, 2.0, 10.5, False), (2.0, None, None, True)]
    delimited.write_table(quality.null_profile(df), str(tmp_path / "nulls"))
    assert spark.read.option("header", True).csv(str(tmp_path / "nulls")).count() == 4
    assert delimited.table_shape(df).first()["n_rows"] == 2


def test_report_and_cluster_sinks(spark, tmp_path):
    lines = spark.createDataFrame([("one",), ("two",)], "line STRING")
    delimited.write_report(lines, str(tmp_path / "report"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "report")).collect()) == ["one", "two"]
    delimited.write_clusters(lines.withColumn("cluster", F.lit(1)), str(tmp_path / "clusters"))
    assert spark.read.parquet(str(tmp_path / "clusters")).count() == 2


def test_head_and_seeded_sample(spark):
    df = spark.range(1000).withColumn("t", F.col("id") % 7)
    assert values(delimited.head_sample(df, ["id"], 5), "id") == [0, 1, 2, 3, 4]
    sample = delimited.seeded_sample(df, ["id"], 50)
    assert sample.count() == 50
    assert sorted(values(sample, "id")) == sorted(values(delimited.seeded_sample(df.repartition(7), ["id"], 50), "id"))
    assert values(sample, "id") != values(delimited.seeded_sample(df, ["id"], 50, seed=1), "id")


def test_bad_lines_of_files(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a;b;c\n1;2;3\n4;5\n"6;7;8\n9;10;11;12\n;;\n"x;y";z;\n')
    (tmp_path / "two.csv").write_text("a;b;c\n1;2;3\n")
    scanned = delimited.scan_delimited(spark, str(tmp_path), ["a", "b", "c"], bad="bad")
    assert sorted(r["bad"] for r in scanned.collect() if r["bad"]) == ['"6;7;8', "4;5", "9;10;11;12"]
    assert ("x;y", "z", None, None) in [tuple(r) for r in scanned.collect()]
    report = {r["file"][-7:]: (r["n_lines"], r["n_bad"]) for r in delimited.line_report(scanned, "bad").collect()}
    assert report == {"one.csv": (6, 3), "two.csv": (1, 0)}
    with pytest.raises(ValueError):
        delimited.scan_delimited(spark, str(tmp_path), bad="bad")


def test_stage_log_adds_no_job(spark):
    """Writing with the log starts as many jobs as writing alone, and an empty stage counts 0 rows."""
    frame, tracker = spark.range(1000).repartition(3), spark.sparkContext.statusTracker()

    def jobs(group, work):
        spark.sparkContext.setJobGroup(group, group)
        work()
        return len(tracker.getJobIdsForGroup(group))

    log = quality.StageLog(spark)
    alone = jobs("alone", lambda: materialize(frame))
    assert jobs("logged", lambda: log.write("all", frame)) == alone
    log.write("none", frame.where("id < 0").withColumn("x", F.lit(1)))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert [tuple(r) for r in log.table().collect()] == [("all", 1000, 1), ("none", 0, 2)]


def test_missing_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "amount DOUBLE, units DOUBLE")
    found = {(r["stage"], r["variable"]): (r["present"], r["consequence"]) for r in quality.missing_columns(
        df, {"features": {"units": "a", "ts": "hour"}, "customers": {"amount": "b", "ts": "recency"}}).collect()}
    assert found == {("features", "units"): (True, None), ("features", "ts"): (False, "left out: hour"),
                     ("customers", "amount"): (True, None), ("customers", "ts"): (False, "left out: recency")}


def test_duplicates_by_digest(spark):
    """Wide rows: nulls in different places differ, zeros of both signs don't, many copies of one row count."""
    rows = [(None, "a", "b", 0.0, 1, "x y"), ("a", None, "b", 0.0, 1, "x y"), ("a", "b", None, -0.0, 1, "x y"), ("a", "b", None, 0.0, 1, "x y")]
    rows += [("q", "r", "s", 2.5, 7, "t")] * 50 + [(None,) * 6] * 3
    df = spark.createDataFrame(rows, "a STRING, b STRING, c STRING, d DOUBLE, e INT, `f.g` STRING").repartition(5)
    assert [quality.duplicate_count(df, wide=w).first()[0] for w in (4, 10)] == [52, 52]
    assert quality.duplicate_count(df.limit(0)).first()[0] == 0
    digests = df.select(quality.row_digest(df.columns).alias("d"))
    assert digests.schema["d"].dataType.simpleString() == "struct<d1:bigint,d2:bigint>"


def test_rows_without_a_repeated_digest_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(50).select(*[(F.col("id") * k).alias(f"c{k}") for k in range(6)])
    found = quality.duplicate_count(df.mapInArrow(counted, df.schema))
    assert found.schema.simpleString() == "struct<duplicates:bigint>" and found.first()[0] == 0 and seen.value == 50
    assert quality.duplicate_count(df.union(df.where("id < 7")).mapInArrow(counted, df.schema)).first()[0] == 7


def test_column_roles_move_numbers_not_texts(spark):
    """Numbers are counted as such (no text of theirs is shuffled), whatever their type; nulls are no value."""
    rows = [(1, 0.5, "a", None, 2 ** 60), (2, 0.5, "b", None, 2 ** 60 + 1), (2, float("nan"), None, None, None), (None, float("nan"), "a", None, 1),
            (3, 0.0, "a", None, 1), (3, -0.0, "a", None, 1)]
    df = spark.createDataFrame(rows, "sku INT, amount DOUBLE, `a.b` STRING, empty DATE, big BIGINT")
    found = quality.column_roles(df)
    assert {r["variable"]: (r["role"], r["n_values"]) for r in found.collect()} == {
        "sku": ("categorical", 3), "amount": ("numeric", 4), "a.b": ("categorical", 2), "empty": ("temporal", 0), "big": ("numeric", 3)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "whole" in plan and "real" in plan
    assert quality.column_roles(df.limit(0)).count() == 0
