"""Derived columns, standardization, descriptive statistics and frequency tables."""

from pyspark.sql import functions as F

from basketlens import config
from basketlens.functions import columns as C
from basketlens.operators import describe, features, order_stats
from basketlens.plans.catalog import query
from basketlens.plans.quality_queries import rounded, union_sql
from basketlens.plans.sales_view import derived, oracle, staged, valid


def feature(spark, d, name):
    lines = valid(spark, d)
    return features.derive_features(staged(lines, "receipt_id", "amount") if name == "amount_segment" else lines, [name])


@query("feature_amount_per_unit", oracle("features", "SELECT receipt_id, amount_per_unit FROM features"))
def feature_amount_per_unit(spark, d):
    return feature(spark, d, "amount_per_unit").select("receipt_id", "amount_per_unit")


@query("feature_age", oracle("features", "SELECT receipt_id, CAST(age AS DOUBLE) AS age FROM features"))
def feature_age(spark, d):
    return feature(spark, d, "age").select("receipt_id", F.col("age").cast("double").alias("age"))


@query("feature_hour", oracle("features", "SELECT receipt_id, CAST(hour AS BIGINT) AS hour FROM features"))
def feature_hour(spark, d):
    return feature(spark, d, "hour").select("receipt_id", F.col("hour").cast("bigint").alias("hour"))


@query("feature_recency", oracle("features", "SELECT receipt_id, CAST(recency_days AS BIGINT) AS recency_days FROM features"))
def feature_recency(spark, d):
    return feature(spark, d, "recency_days").select("receipt_id", "recency_days")


@query("event_recency", """SELECT event_id, date_sub('day', ts, (SELECT max(ts) FROM events)) AS recency_days,
  CAST(hour(ts) AS BIGINT) AS hour, isodow(ts) >= 6 AS is_weekend FROM events""")
def event_recency(spark, d):
    """The time features on the microsecond timestamps of the events table."""
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", "ts")
    return events.select("event_id", features.recency_days(events).alias("recency_days"),
                         F.hour("ts").cast("bigint").alias("hour"), features.is_weekend().alias("is_weekend"))


@query("feature_weekend", oracle("features", "SELECT receipt_id, is_weekend FROM features"))
def feature_weekend(spark, d):
    return feature(spark, d, "is_weekend").select("receipt_id", C.true_or_false(F.col("is_weekend")).alias("is_weekend"))


@query("feature_segment", oracle("features", "SELECT receipt_id, amount_segment FROM features"))
def feature_segment(spark, d):
    return feature(spark, d, "amount_segment").select("receipt_id", "amount_segment")


@query("feature_gross_amount", oracle("features", "SELECT receipt_id, gross_amount FROM features"))
def feature_gross_amount(spark, d):
    return feature(spark, d, "gross_amount").select("receipt_id", "gross_amount")


@query("feature_frequency", oracle("features", "SELECT receipt_id, customer_id, CAST(purchase_freq AS DOUBLE) AS purchase_freq FROM features"))
def feature_frequency(spark, d):
    return feature(spark, d, "purchase_freq").select(
        "receipt_id", "customer_id", F.col("purchase_freq").cast("double").alias("purchase_freq"))


DERIVED_ROWS = """receipt_id, CAST(line_no AS BIGINT) AS line_no, amount_per_unit, CAST(age AS DOUBLE) AS age,
  CAST(hour AS DOUBLE) AS hour, CAST(purchase_freq AS DOUBLE) AS purchase_freq,
  CAST(recency_days AS DOUBLE) AS recency_days, gross_amount, is_weekend, amount_segment"""


def derived_rows(df):
    counts = [F.col(c).cast("double").alias(c) for c in ("age", "hour", "purchase_freq", "recency_days")]
    return df.select("receipt_id", F.col("line_no").cast("bigint").alias("line_no"), "amount_per_unit", *counts,
                     "gross_amount", "is_weekend", "amount_segment")


@query("derive_features", oracle("features", f"SELECT {DERIVED_ROWS} FROM features"))
def derive_features(spark, d):
    return derived_rows(features.derive_features(staged(valid(spark, d))))


@query("validate_derived", oracle("derived", f"SELECT {DERIVED_ROWS} FROM derived"))
def validate_derived(spark, d):
    return derived_rows(derived(spark, d))


# ---- standardization --------------------------------------------------------------------

@query("zscore_params", oracle("derived", union_sql([
    f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std FROM derived"
    for c in config.SCALED])))
def zscore_params(spark, d):
    return rounded(features.scaling_parameters(derived(spark, d)), 4, "mean", "std")


@query("zscore", oracle("derived", "p AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in config.SCALED) + " FROM derived) SELECT receipt_id, "
    + ", ".join(f"round(({c} - {c}_m) / {c}_s, 6) AS {c}_scaled" for c in config.SCALED) + " FROM derived, p"))
def zscore(spark, d):
    scaled = [f"{c}_scaled" for c in config.SCALED]
    return rounded(features.standardize(derived(spark, d)).select("receipt_id", *scaled), 6, *scaled)


# ---- descriptive statistics -------------------------------------------------------------

def describe_sql(c, table):
    return (f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 4) AS mean, "
            f"round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q1, "
            f"round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3, "
            f"round(max({c}), 4) AS max FROM {table}")


@query("describe", oracle("valid", "w AS (SELECT * REPLACE (receipt_id::DOUBLE AS receipt_id) FROM valid) "
                          + union_sql([describe_sql(c, "w") for c in config.NUMERIC])))
def describe_base(spark, d):
    found = describe.describe(staged(valid(spark, d), *config.NUMERIC), config.NUMERIC)
    return rounded(found, 4, "mean", "std", "min", "q1", "median", "q3", "max")


@query("describe_derived", oracle("derived", union_sql([describe_sql(c, "derived") for c in config.DERIVED_NUMERIC])))
def describe_derived(spark, d):
    found = describe.describe(staged(derived(spark, d), *config.DERIVED_NUMERIC), config.DERIVED_NUMERIC)
    return rounded(found, 4, "mean", "std", "min", "q1", "median", "q3", "max")


def full_sql(columns, table):
    def one(c):
        # Biased moments about the mean; a null that is the most frequent is the mode.
        return f"""SELECT '{c}' AS variable, round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.5), 4) AS median,
  (SELECT round({c}, 4) FROM {table} GROUP BY {c} ORDER BY count(*) DESC, {c} ASC NULLS LAST LIMIT 1) AS mode,
  round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(max({c}) - min({c}), 4) AS range,
  round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.75), 4) AS q3,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr, round(stddev_samp({c}), 4) AS std,
  round(var_samp({c}), 2) AS variance, round(stddev_samp({c}) / nullif(avg({c}), 0), 6) AS variation,
  round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 4) AS skewness,
  round(avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3, 4) AS kurtosis
FROM {table}, (SELECT avg({c}) AS m FROM {table})"""
    return union_sql([one(c) for c in columns])


def full_rows(found):
    found = rounded(found, 4, "mean", "median", "mode", "min", "max", "range", "q1", "q3", "iqr", "std",
                    "skewness", "kurtosis")
    return rounded(rounded(found, 2, "variance"), 6, "variation")


@query("full_stats_base", oracle("valid", full_sql(config.MEASURES, "valid")))
def full_stats_base(spark, d):
    return full_rows(describe.full_statistics(staged(valid(spark, d), *config.MEASURES), config.MEASURES))


@query("full_stats_derived", oracle("derived", full_sql(config.DERIVED_NUMERIC, "derived")))
def full_stats_derived(spark, d):
    return full_rows(describe.full_statistics(staged(derived(spark, d), *config.DERIVED_NUMERIC), config.DERIVED_NUMERIC))


PROBABILITIES = [0.25, 0.33, 0.5, 0.66, 0.75]


@query("quantiles", oracle("valid", union_sql([
    f"SELECT '{c}' AS variable, {p}::DOUBLE AS probability, round(quantile_cont({c}::DOUBLE, {p}), 4) AS quantile FROM valid"
    for c in config.NUMERIC for p in PROBABILITIES])))
def quantiles(spark, d):
    found = order_stats.quantiles(staged(valid(spark, d), *config.NUMERIC), config.NUMERIC, PROBABILITIES)
    return rounded(found, 4, "quantile").select("variable", "probability", "quantile")


@query("quantiles_approx")
def quantiles_approx(spark, d):
    return order_stats.quantiles_approx(valid(spark, d), config.NUMERIC, PROBABILITIES)


FREQUENCY_COLUMNS = [*config.CATEGORICAL, "birth_date"]


@query("freq_table", oracle("valid", union_sql([
    f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM valid GROUP BY {c}"
    for c in FREQUENCY_COLUMNS])
    + " UNION ALL SELECT 'ts', strftime(ts, '%Y-%m-%d %H:%M:%S'), count(*) FROM valid GROUP BY ts"))
def freq_table(spark, d):
    return describe.frequencies(valid(spark, d), [*FREQUENCY_COLUMNS, "ts"])


@query("freq_table_derived", oracle("derived", union_sql([
    f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM derived GROUP BY {c}"
    for c in ("is_weekend", "amount_segment")])))
def freq_table_derived(spark, d):
    return describe.frequencies(derived(spark, d, "is_weekend", "amount_segment"), ["is_weekend", "amount_segment"])


@query("freq_by_day", oracle("valid", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n FROM valid GROUP BY 1"""))
def freq_by_day(spark, d):
    return describe.day_frequencies(valid(spark, d), k=None).select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "n")


@query("top_k_freq", oracle("valid", """
SELECT product AS value, count(*) AS n FROM valid WHERE product IS NOT NULL GROUP BY product
ORDER BY n DESC, value LIMIT 20"""))
def top_k_freq(spark, d):
    return describe.top_frequencies(valid(spark, d), "product")
