"""Sources, coercion, rules, profiles, outliers and the null policy."""

import uuid

from pyspark.sql import functions as F

from basketlens import config
from basketlens.functions import columns as C
from basketlens.operators import features, order_stats, quality, skew
from basketlens.plans.catalog import query
from basketlens.plans.sales_view import (
    DERIVED_SQL, FEATURES_SQL, customers, derived, oracle, sales, staged, valid)
from basketlens.sources import delimited
from basketlens.sources.staging import discard, remember, shared_folder, temporary

ALL = ["receipt_id", "line_no", "sku", "units", "discount_pct", "amount", "store", "gender", "channel",
       "status", "product", "first_name", "last_name", "customer_run", "customer_id", "ts", "birth_date"]
TOTAL_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in ALL)


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def union_sql(parts):
    return " UNION ALL ".join(parts)


# ---- sources ----------------------------------------------------------------------------

TEXT_COLUMNS = ["receipt_id", "units", "amount", "channel", "customer_id"]


def sales_text(spark, d, *extra):
    """Every sales line as delimited text, with a bad number on each thirteenth receipt."""
    lines = sales(spark, d)
    units = F.when(F.col("receipt_id") % 13 == 0, "abc").otherwise(F.col("units").cast("int").cast("string"))
    cents = F.round(F.col("amount") * 100).cast("bigint").cast("string")
    fields = [F.col("receipt_id").cast("string"), units, cents, F.col("channel"), F.col("customer_id")]
    return lines.select(*extra, F.concat_ws(";", *[F.coalesce(f, F.lit("")) for f in fields]).alias("line"))


def as_files(lines, *by):
    """The lines as text files in the shared folder, one folder for each value of ``by``."""
    spark = lines.sparkSession
    path = remember(spark, f"{shared_folder(spark)}/text/{uuid.uuid4().hex}")
    lines.write.partitionBy(*by).text(path)
    return path


@query("scan_bad_lines", oracle("sales", """
SELECT CAST(store AS BIGINT) AS store, count(*) AS n_lines, count(*) FILTER (WHERE receipt_id % 19 = 0 OR receipt_id % 31 = 0) AS n_bad,
  count(CASE WHEN receipt_id % 13 <> 0 AND receipt_id % 19 <> 0 AND receipt_id % 31 <> 0 THEN units END) AS units_parsed
FROM sales GROUP BY store"""))
def scan_bad_lines(spark, d):
    """Files with short lines (each 19th receipt) and quotes that never end (each 31st), one folder for each store."""
    lines = sales_text(spark, d, F.col("store").cast("bigint").alias("store"), F.col("receipt_id").alias("r"))
    line = (F.when(F.col("r") % 19 == 0, F.substring_index("line", ";", 2))
            .when(F.col("r") % 31 == 0, F.regexp_replace("line", "^([^;]*;[^;]*;[^;]*;)", '$1"')).otherwise(F.col("line")))
    path = as_files(lines.select("store", line.alias("line")), "store")
    scanned = delimited.scan_delimited(spark, path + "/*", TEXT_COLUMNS, header=False, bad="bad_line")
    report = delimited.line_report(scanned, "bad_line", {"units_parsed": F.count(F.when(F.col("bad_line").isNull(), C.number(scanned, "units")))})
    folder = F.regexp_extract("file", r"store=(\d+)", 1).cast("bigint")
    return report.groupBy(folder.alias("store")).agg(*[F.sum(c).alias(c) for c in ("n_lines", "n_bad", "units_parsed")])


@query("scan_delimited", oracle("sales", """
SELECT count(*) AS n_rows, count(CASE WHEN receipt_id % 13 <> 0 THEN units END) AS units_parsed,
  CAST(sum(CASE WHEN receipt_id % 13 <> 0 THEN units END) AS DOUBLE) AS units_sum,
  count(amount) AS amount_parsed, count(channel) AS channel_present,
  count(DISTINCT customer_id) AS customers
FROM sales"""))
def scan_delimited(spark, d):
    """Files of the lines, scanned as such."""
    fields = delimited.scan_delimited(spark, as_files(sales_text(spark, d)), TEXT_COLUMNS, header=False)
    parsed = quality.coerce_numeric(fields, ["units", "amount"])
    return parsed.agg(F.count("*").alias("n_rows"), F.count("units").alias("units_parsed"),
                      F.sum("units").alias("units_sum"), F.count("amount").alias("amount_parsed"),
                      F.count("channel").alias("channel_present"),
                      F.count_distinct("customer_id").alias("customers"))


@query("table_shape", oracle("valid", f"SELECT count(*) AS n_rows, CAST({len(ALL)} AS BIGINT) AS n_columns, true AS in_partitions FROM valid"))
def table_shape(spark, d):
    """The number of partitions depends on the cluster; what can be checked is that there are any, and no more than rows."""
    return delimited.table_shape(valid(spark, d)).select(
        "n_rows", "n_columns", F.col("n_partitions").between(1, F.col("n_rows")).alias("in_partitions"))


@query("head_sample", oracle("valid", f"""
SELECT receipt_id, CAST(line_no AS BIGINT) AS line_no, round(amount, 4) AS amount, channel
FROM valid ORDER BY {TOTAL_ORDER} LIMIT 50000"""))
def head_sample(spark, d):
    head = delimited.head_sample(valid(spark, d), ALL, 50_000, ["receipt_id", "line_no", "amount", "channel"])
    return rounded(head.withColumn("line_no", F.col("line_no").cast("bigint")), 4, "amount")


@query("seeded_sample", oracle("customers", """
SELECT customer_id, purchase_count FROM customers
ORDER BY md5(concat_ws('|', customer_id, '42')), customer_id LIMIT 500"""))
def seeded_sample(spark, d):
    return delimited.seeded_sample(customers(spark, d).select("customer_id", "purchase_count"), ["customer_id"], 500)


# ---- sinks: written and read back -------------------------------------------------------

def sink(spark, kind):
    return remember(spark, f"{shared_folder(spark)}/{kind}/{uuid.uuid4().hex}")


@query("sink_table", oracle("valid", """
SELECT channel, CAST(store AS BIGINT) AS store, count(*) AS n, CAST(sum(units) AS BIGINT) AS units
FROM valid GROUP BY channel, store"""))
def sink_table(spark, d):
    """A result table as CSV."""
    cells = valid(spark, d).groupBy("channel", F.col("store").cast("bigint").alias("store")).agg(
        F.count("*").alias("n"), F.sum("units").cast("bigint").alias("units"))
    path = sink(spark, "csv")
    delimited.write_table(cells, path)
    return spark.read.option("header", True).schema(cells.schema).csv(path)


@query("sink_parameters", oracle("valid", union_sql([
    f"SELECT '{c}' AS variable, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM valid" for c in config.MEASURES])))
def sink_parameters(spark, d):
    """Scaling parameters as JSON."""
    path = sink(spark, "json")
    delimited.write_parameters(features.scaling_parameters(valid(spark, d), config.MEASURES), path)
    found = delimited.read_parameters(spark, path)
    return rounded(found.withColumnRenamed("column", "variable"), 6, "mean", "std")


@query("sink_report", oracle("valid", "p AS (" + union_sql([
    f"SELECT '{c}' AS variable, count(*) - count({c}) AS nulls FROM valid" for c in ALL]) + """)
SELECT variable || ': ' || nulls || ' nulls' AS line FROM p"""))
def sink_report(spark, d):
    """Report lines as text."""
    lines = quality.null_profile(valid(spark, d)).select(
        F.concat(F.col("variable"), F.lit(": "), F.col("nulls").cast("string"), F.lit(" nulls")).alias("line"))
    path = sink(spark, "report")
    delimited.write_report(lines, path)
    return spark.read.text(path).withColumnRenamed("value", "line")


# ---- coercion and rules -----------------------------------------------------------------

@query("coerce_numeric", oracle("sales", """
SELECT receipt_id, CASE WHEN receipt_id % 13 <> 0 THEN CAST(CAST(units AS INT) AS DOUBLE) END AS units,
  round(amount * 100, 0) AS amount FROM sales"""))
def coerce_numeric(spark, d):
    fields = delimited.parse_delimited(sales_text(spark, d), "line", TEXT_COLUMNS)
    parsed = quality.coerce_numeric(fields, ["units", "amount"])
    return parsed.select(F.col("receipt_id").try_cast("bigint").alias("receipt_id"), "units", "amount")


@query("coerce_timestamp", oracle("sales", """
SELECT receipt_id, CASE WHEN receipt_id % 17 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
  CASE WHEN receipt_id % 17 <> 0 THEN CAST(year(ts) AS DOUBLE) END AS ts_year FROM sales"""))
def coerce_timestamp(spark, d):
    stamp = F.when(F.col("receipt_id") % 17 == 0, "31/02/2020").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    text = sales(spark, d).select("receipt_id", stamp.alias("ts"))
    parsed = quality.coerce_timestamps(text, ["ts"])
    return parsed.select("receipt_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                         F.year("ts").cast("double").alias("ts_year"))


@query("rule_range", oracle("sales", """
SELECT receipt_id, CAST(line_no AS BIGINT) AS line_no,
  CASE WHEN discount_pct >= 0 AND discount_pct <= 1 THEN discount_pct END AS discount_pct FROM sales"""))
def rule_range(spark, d):
    return sales(spark, d).select("receipt_id", F.col("line_no").cast("bigint").alias("line_no"),
                                  C.in_range(F.col("discount_pct"), *config.DISCOUNT_RANGE).alias("discount_pct"))


@query("rule_nonnegative", oracle("sales", """
SELECT receipt_id, round(CASE WHEN amount - 50000 >= 0 THEN amount - 50000 END, 4) AS surplus FROM sales"""))
def rule_nonnegative(spark, d):
    surplus = F.col("amount") - 50_000
    return sales(spark, d).select("receipt_id", F.round(C.in_range(surplus, 0.0, C.INF), 4).alias("surplus"))


@query("rule_domain", oracle("sales", """
SELECT receipt_id, CASE WHEN gender = 1 OR gender = 2 THEN gender END AS gender FROM sales"""))
def rule_domain(spark, d):
    return sales(spark, d).select("receipt_id", C.in_domain(F.col("gender"), config.GENDERS).alias("gender"))


@query("rule_domain_sentinel", oracle("sales", """
SELECT receipt_id, CASE WHEN channel IN ('BUILDING', 'MACHINERY') THEN channel ELSE 'Desconocido' END AS channel
FROM sales"""))
def rule_domain_sentinel(spark, d):
    known = C.in_domain_or(F.col("channel"), ["BUILDING", "MACHINERY"], config.SEGMENT_UNKNOWN)
    return sales(spark, d).select("receipt_id", known.alias("channel"))


@query("rule_pattern", oracle("sales", """
SELECT receipt_id, CASE WHEN length(customer_id) = 36 AND len(string_split(customer_id, '-')) = 5
  THEN lower(customer_id) END AS customer_id FROM sales"""))
def rule_pattern(spark, d):
    return sales(spark, d).select("receipt_id", C.matching(F.col("customer_id")).alias("customer_id"))


@query("clamp_min", oracle("sales", """
SELECT receipt_id, CASE WHEN units IS NULL OR units < 10 THEN 10.0::DOUBLE ELSE units END AS units FROM sales"""))
def clamp_min(spark, d):
    return sales(spark, d).select("receipt_id", C.at_least(F.col("units"), 10.0).alias("units"))


@query("rule_violations", oracle("sales", union_sql([
    "SELECT 'discount_pct_range' AS rule, count(*) FILTER (WHERE discount_pct < 0 OR discount_pct > 1) AS violations FROM sales",
    "SELECT 'gender_domain', count(*) FILTER (WHERE gender IS NULL OR gender NOT IN (1, 2)) FROM sales",
    "SELECT 'customer_id_pattern', count(*) FILTER (WHERE customer_id IS NULL OR NOT regexp_full_match("
    "lower(customer_id), '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}')) FROM sales"])))
def rule_violations(spark, d):
    return quality.rule_violations(sales(spark, d))


@query("validate_base", oracle("valid", """
SELECT receipt_id, CAST(line_no AS BIGINT) AS line_no, sku, units, discount_pct, round(amount, 4) AS amount, store,
  gender, customer_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(birth_date, '%Y-%m-%d') AS birth_date
FROM valid"""))
def validate_base(spark, d):
    return valid(spark, d).select(
        "receipt_id", F.col("line_no").cast("bigint").alias("line_no"), "sku", "units", "discount_pct",
        F.round("amount", 4).alias("amount"), "store", "gender", "customer_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.date_format("birth_date", "yyyy-MM-dd").alias("birth_date"))


@query("drop_null_rows", oracle("valid", """
SELECT receipt_id, units, round(amount, 4) AS amount, gender FROM valid
WHERE units IS NOT NULL AND amount IS NOT NULL AND gender IS NOT NULL"""))
def drop_null_rows(spark, d):
    kept = quality.drop_null_rows(valid(spark, d), ["units", "amount", "gender"])
    return kept.select("receipt_id", "units", F.round("amount", 4).alias("amount"), "gender")


@query("replace_infinite", oracle("valid", """
SELECT receipt_id, CASE WHEN units <> 1 THEN amount / nullif(units - 1, 0) END AS per_extra_unit FROM valid"""))
def replace_infinite(spark, d):
    ratio = valid(spark, d).select(
        "receipt_id", C.ieee_divide(F.col("amount"), F.col("units") - 1).alias("per_extra_unit"))
    return quality.replace_infinite(ratio, ["per_extra_unit"])


# ---- profiles ---------------------------------------------------------------------------

def null_row(c, table="valid"):
    return (f"SELECT '{c}' AS variable, count(*) - count({c}) AS nulls, "
            f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS pct FROM {table}")


@query("null_profile", oracle("valid", union_sql([null_row(c) for c in ALL])))
def null_profile(spark, d):
    return rounded(quality.null_profile(valid(spark, d)), 6, "pct")


@query("null_profile_groups", oracle("valid", union_sql([
    f"SELECT '{g}' AS column_group, * FROM ({null_row(c)})"
    for g, cols in config.NULL_PROFILE_GROUPS.items() for c in cols])))
def null_profile_groups(spark, d):
    return rounded(quality.null_profile_groups(valid(spark, d)), 6, "pct")


@query("duplicate_count", oracle("sales", """
SELECT 'line' AS scope, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales)) AS duplicates FROM sales
UNION ALL
SELECT 'channel and product', count(*) - (SELECT count(*) FROM (SELECT DISTINCT channel, product FROM sales)) FROM sales
UNION ALL
SELECT 'receipt line', count(*) - (SELECT count(*) FROM (SELECT DISTINCT receipt_id, line_no FROM sales)) FROM sales"""))
def duplicate_count(spark, d):
    """The joined lines are written once for the three scopes."""
    lines = staged(sales(spark, d))
    scopes = {"line": None, "channel and product": ["channel", "product"], "receipt line": ["receipt_id", "line_no"]}
    counts = [quality.duplicate_count(lines, cols).select(F.lit(s).alias("scope"), "duplicates")
              for s, cols in scopes.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


SPARK_TYPES = {"receipt_id": "bigint", "line_no": "int", "sku": "double", "units": "double",
               "discount_pct": "double", "amount": "double", "store": "double", "gender": "double",
               "ts": "timestamp_ntz", "birth_date": "date"}


@query("type_table", oracle("valid", union_sql([
    f"SELECT '{c}' AS variable, '{SPARK_TYPES.get(c, 'string')}' AS dtype, count({c}) AS non_null FROM valid"
    for c in ALL])))
def type_table(spark, d):
    return quality.type_table(valid(spark, d))


def column_role_sql(c):
    if c in config.DATES:
        return "temporal"
    return "numeric" if c in (*config.MEASURES, *config.DERIVED_NUMERIC, "line_no") else "categorical"


@query("column_roles", oracle("derived", union_sql([
    f"SELECT '{c}' AS variable, '{column_role_sql(c)}' AS role, count(DISTINCT {c}) AS n_values FROM derived"
    for c in [*ALL, *config.DERIVED]])))
def column_roles(spark, d):
    return quality.column_roles(derived(spark, d))


@query("missingness_mechanism", oracle("valid", "r AS (" + union_sql([
    f"SELECT '{t}' AS target, '{p}' AS probe, count(*) FILTER (WHERE {t} IS NULL) AS nulls, count(*) AS total, "
    f"avg({p}) FILTER (WHERE {t} IS NULL) AS mean_missing, avg({p}) FILTER (WHERE {t} IS NOT NULL) AS mean_present "
    "FROM valid" for t in config.MISSINGNESS_TARGETS for p in config.MISSINGNESS_PROBES if t != p]) + """)
SELECT target, nulls, round(nulls * 100.0::DOUBLE / total, 6) AS pct, probe, round(mean_missing, 4) AS mean_missing,
  round(mean_present, 4) AS mean_present,
  round(abs(mean_missing - mean_present) / abs(mean_present), 6) AS relative_difference,
  abs(mean_missing - mean_present) / abs(mean_present) > 0.1 AS not_mcar
FROM r WHERE nulls > 0 AND mean_missing IS NOT NULL AND mean_present <> 0"""))
def missingness_mechanism(spark, d):
    found = quality.missingness_mechanism(valid(spark, d))
    return rounded(rounded(found, 6, "pct", "relative_difference"), 4, "mean_missing", "mean_present")


@query("stage_metrics", oracle("derived", """
SELECT 'loaded' AS stage, count(*) AS n_rows, CAST(17 AS BIGINT) AS n_columns FROM sales
UNION ALL SELECT 'validated', count(*), 17 FROM valid
UNION ALL SELECT 'derived', count(*), 25 FROM derived
UNION ALL SELECT 'complete', count(*), 25 FROM derived
  WHERE units IS NOT NULL AND discount_pct IS NOT NULL AND amount IS NOT NULL AND gender IS NOT NULL"""))
def stage_metrics(spark, d):
    """Each stage is written once and read by the next; its metrics come from the write."""
    log = quality.StageLog(spark)
    checked = log.write("validated", quality.validate_base(log.write("loaded", sales(spark, d))))
    full = log.write("derived", quality.validate_derived(features.derive_features(checked)))
    log.write("complete", quality.drop_null_rows(full, config.NUMERIC))
    return log.table()


# Optional columns that the frame lacks; the statement takes the column names from a row.
@query("missing_columns", oracle("sales", """
names AS (SELECT DISTINCT unnest(json_keys(to_json(s))) AS variable FROM (SELECT * EXCLUDE (birth_date, channel) FROM sales LIMIT 1) s)
SELECT stage, e.variable, n.variable IS NOT NULL AS present,
  CASE WHEN n.variable IS NULL THEN 'left out: ' || lost END AS consequence
FROM (VALUES """ + ", ".join(f"('{stage}', '{c}', '{lost}')" for stage, columns in config.EXPECTED.items() for c, lost in columns.items())
    + """) e(stage, variable, lost) LEFT JOIN names n ON e.variable = n.variable"""))
def missing_columns(spark, d):
    return quality.missing_columns(sales(spark, d).drop("birth_date", "channel"))


# ---- outliers ---------------------------------------------------------------------------

def iqr_sql(table):
    return union_sql([f"SELECT '{c}' AS variable, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, "
                      f"count(*) AS total FROM {table}" for c in config.NUMERIC])


def trimmed_sql(source):
    """The source with the values outside its own IQR bounds nulled."""
    columns = ", ".join(
        f"CASE WHEN b.{c}3 - b.{c}1 > 0 AND ({c} < b.{c}1 - 1.5 * (b.{c}3 - b.{c}1) OR "
        f"{c} > b.{c}3 + 1.5 * (b.{c}3 - b.{c}1)) THEN NULL ELSE {c} END AS {c}" for c in config.NUMERIC)
    bounds = ", ".join(f"quantile_cont({c}, 0.25) AS {c}1, quantile_cont({c}, 0.75) AS {c}3" for c in config.NUMERIC)
    return f"SELECT v.* REPLACE ({columns}) FROM {source} v, (SELECT {bounds} FROM {source}) b"


@query("iqr_bounds", oracle("valid", f"""
q AS ({iqr_sql('valid')}) SELECT variable, round(q1, 4) AS q1, round(q3, 4) AS q3,
  round(q1 - 1.5 * (q3 - q1), 4) AS lower, round(q3 + 1.5 * (q3 - q1), 4) AS upper FROM q WHERE q3 > q1"""))
def iqr_bounds(spark, d):
    return rounded(quality.iqr_bounds(staged(valid(spark, d), *config.NUMERIC)), 4, "q1", "q3", "lower", "upper")


@query("iqr_outlier_counts", oracle("valid", f"""q AS ({iqr_sql('valid')}),
b AS (SELECT variable, total, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q WHERE q3 > q1),
x AS ({union_sql([f"SELECT '{c}' AS variable, {c}::DOUBLE AS value FROM valid" for c in config.NUMERIC])})
SELECT variable, round(any_value(lower), 4) AS lower, round(any_value(upper), 4) AS upper,
  count(*) FILTER (WHERE value < lower OR value > upper) AS outliers,
  round(count(*) FILTER (WHERE value < lower OR value > upper) * 100.0::DOUBLE / any_value(total), 6) AS pct
FROM x JOIN b USING (variable) GROUP BY variable"""))
def iqr_outlier_counts(spark, d):
    found = quality.iqr_outlier_counts(staged(valid(spark, d), *config.NUMERIC))
    return rounded(rounded(found, 4, "lower", "upper"), 6, "pct")


def trimmed_rows(df):
    return df.select("receipt_id", F.col("line_no").cast("bigint").alias("line_no"), "sku", "units", "discount_pct",
                     F.round("amount", 4).alias("amount"), "store", "gender")


TRIMMED_ROWS = ("receipt_id, CAST(line_no AS BIGINT) AS line_no, sku, units, discount_pct, "
                "round(amount, 4) AS amount, store, gender")


@query("iqr_null_outliers", oracle("valid", f"t AS ({trimmed_sql('valid')}) SELECT {TRIMMED_ROWS} FROM t"))
def iqr_null_outliers(spark, d):
    return trimmed_rows(quality.iqr_null_outliers(staged(valid(spark, d), "line_no", *config.NUMERIC)))


@query("iqr_two_pass", oracle("valid", f"""t1 AS ({trimmed_sql('valid')}), t2 AS ({trimmed_sql('t1')})
SELECT {TRIMMED_ROWS} FROM t2"""))
def iqr_two_pass(spark, d):
    return trimmed_rows(quality.iqr_null_outliers(staged(valid(spark, d), "line_no", *config.NUMERIC), passes=2))


# ---- null policy and imputation ---------------------------------------------------------

PLANNED = [*config.NUMERIC, "first_name"]
ACTION = ("CASE WHEN nulls = 0 THEN 'keep' WHEN nulls * 100.0::DOUBLE / total <= 5 THEN 'drop_rows' "
          "WHEN nulls * 100.0::DOUBLE / total <= 20 THEN 'impute' ELSE 'drop_column' END")


@query("null_policy_plan", oracle("valid", f"t AS ({trimmed_sql('valid')}), n AS (" + union_sql([
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS variable, count(*) - count({c}) AS nulls, count(*) AS total FROM t"
    for i, c in enumerate(PLANNED)]) + f""")
SELECT position, variable, nulls, round(nulls * 100.0::DOUBLE / total, 6) AS pct, {ACTION} AS action FROM n"""))
def null_policy_plan(spark, d):
    trimmed = quality.iqr_null_outliers(staged(valid(spark, d), *PLANNED))
    return rounded(quality.null_policy_plan(trimmed, PLANNED), 6, "pct")


# The statement states the plan that null_policy_plan finds on this data: rows without units,
# discount or gender go, the amount is imputed on the rows left by the columns before it.
@query("null_policy", oracle("valid", f"""t1 AS ({trimmed_sql('valid')}), t AS ({trimmed_sql('t1')}),
m AS (SELECT quantile_cont(amount, 0.5) AS amount FROM t WHERE units IS NOT NULL AND discount_pct IS NOT NULL)
SELECT receipt_id, sku, units, discount_pct, round(coalesce(t.amount, m.amount), 4) AS amount, store, gender
FROM t, m WHERE units IS NOT NULL AND discount_pct IS NOT NULL AND gender IS NOT NULL"""))
def null_policy(spark, d):
    cleaned = quality.apply_null_policy(quality.iqr_null_outliers(staged(valid(spark, d), *PLANNED), passes=2), PLANNED)
    return cleaned.select("receipt_id", "sku", "units", "discount_pct", F.round("amount", 4).alias("amount"),
                          "store", "gender")


# On the cleaned lines only the age has nulls among the derived columns, and it is imputed.
@query("null_policy_derived", oracle("valid", f"""t1 AS ({trimmed_sql('valid')}), t2 AS ({trimmed_sql('t1')}),
m AS (SELECT quantile_cont(amount, 0.5) AS amount FROM t2 WHERE units IS NOT NULL AND discount_pct IS NOT NULL),
cleaned AS (SELECT t2.* REPLACE (coalesce(t2.amount, m.amount) AS amount) FROM t2, m
            WHERE units IS NOT NULL AND discount_pct IS NOT NULL AND gender IS NOT NULL),
features AS ({FEATURES_SQL.replace('FROM valid', 'FROM cleaned')}), derived AS ({DERIVED_SQL}),
a AS (SELECT quantile_cont(age, 0.5) AS age FROM derived)
SELECT receipt_id, CAST(CAST(amount_per_unit AS FLOAT) AS DOUBLE) AS amount_per_unit, coalesce(derived.age, a.age) AS age,
  hour, purchase_freq, recency_days, CAST(CAST(gross_amount AS FLOAT) AS DOUBLE) AS gross_amount, is_weekend, amount_segment
FROM derived, a"""))
def null_policy_derived(spark, d):
    # Each stage fits its decisions on the previous one, so stages are written once, with the columns that a later one reads, and
    # deleted when the next is written. A column that the policy has dropped is not asked for.
    inputs, outputs = features.needed_for(config.DERIVED), ["receipt_id", *config.DERIVED]
    with temporary(spark) as keep:
        lines = staged(valid(spark, d), *dict.fromkeys([*config.NUMERIC, *inputs]), compact=True)
        cleaned = quality.clean_base(lines)
        cleaned = keep(staged(cleaned, *config.present(cleaned, inputs), compact=True))
    with temporary(spark) as keep:
        frame = quality.validate_derived(features.derive_features(cleaned))
        frame = keep(staged(frame, *config.present(frame, outputs), compact=True))
    discard(cleaned)
    treated = quality.apply_null_policy(frame, config.DERIVED).select("receipt_id", *config.DERIVED)
    return treated.withColumns({c: F.col(c).cast("float").cast("double") for c in ("amount_per_unit", "gross_amount")})


@query("impute_median", oracle("valid", """
m AS (SELECT quantile_cont(units, 0.5) AS units, quantile_cont(amount, 0.5) AS amount FROM valid)
SELECT receipt_id, coalesce(v.units, m.units) AS units, round(coalesce(v.amount, m.amount), 4) AS amount
FROM valid v, m"""))
def impute_median(spark, d):
    filled = quality.impute_median(staged(valid(spark, d), "receipt_id", "units", "amount"), ["units", "amount"])
    return filled.select("receipt_id", "units", F.round("amount", 4).alias("amount"))


def most_frequent_sql(c):
    return f"SELECT {c} FROM valid WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1"


@query("impute_mode", oracle("valid", f"""
SELECT receipt_id, coalesce(channel, ({most_frequent_sql('channel')})) AS channel,
  coalesce(first_name, ({most_frequent_sql('first_name')})) AS first_name FROM valid"""))
def impute_mode(spark, d):
    filled = quality.impute_mode(valid(spark, d), ["channel", "first_name"])
    return filled.select("receipt_id", "channel", "first_name")


@query("mode_value", oracle("valid", "c AS (" + union_sql([
    f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS mode, count(*) AS n FROM valid WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ("channel", "product", "status", "first_name")]) + """)
SELECT variable, mode, n FROM c QUALIFY row_number() OVER (PARTITION BY variable ORDER BY n DESC, mode) = 1"""))
def mode_value(spark, d):
    return order_stats.modes(valid(spark, d), ["channel", "product", "status", "first_name"])


@query("block_assign", oracle("valid", f"""
b AS (SELECT *, (row_number() OVER (ORDER BY {TOTAL_ORDER}) - 1) // 5000 AS block FROM valid)
SELECT block, count(*) AS n, min(receipt_id) AS first_receipt, max(receipt_id) AS last_receipt,
  CAST(sum(units) AS DOUBLE) AS units, count(DISTINCT customer_id) AS customers FROM b GROUP BY block"""))
def block_assign(spark, d):
    blocked = skew.with_blocks(valid(spark, d), ALL, config.BLOCK_ROWS)
    return blocked.groupBy("block").agg(
        F.count("*").alias("n"), F.min("receipt_id").alias("first_receipt"),
        F.max("receipt_id").alias("last_receipt"), F.sum("units").alias("units"),
        F.count_distinct("customer_id").alias("customers"))
