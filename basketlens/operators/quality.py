"""Validation rules, null and duplicate profiles, outliers and the tiered null policy."""

from pyspark.sql import Observation, functions as F
from pyspark.sql import types as T

from basketlens import config
from basketlens.config import present
from basketlens.functions import columns as C
from basketlens.operators import order_stats
from basketlens.operators.skew import attach_by_key
from basketlens.sources.staging import materialize

WIDE_COLUMNS = 4  # rows of more are counted by a digest before they are compared


# ---- coercion and rules -----------------------------------------------------------------

def coerce_numeric(df, columns=config.NUMERIC):
    """Text columns become double (malformed → null); identifiers that are integral stay so."""
    changed = {}
    for c in present(df, columns):
        if not isinstance(df.schema[c].dataType, (T.LongType, T.IntegerType)):
            changed[c] = C.number(df, c)
    return df.withColumns(changed)


def coerce_timestamps(df, columns=config.DATES):
    return df.withColumns({c: C.timestamp(df, c) for c in present(df, columns)})


def validate_base(df):
    """Types, then the discount range, the gender domain, the customer id pattern, then dates."""
    df = coerce_numeric(df)
    rules = {
        "discount_pct": lambda c: C.in_range(c, *config.DISCOUNT_RANGE),
        "gender": lambda c: C.in_domain(c, config.GENDERS),
        "customer_id": lambda c: C.matching(c),
    }
    df = df.withColumns({c: rules[c](F.col(c)) for c in present(df, rules)})
    return coerce_timestamps(df)


def validate_derived(df):
    """Domain rules of the derived columns; numbers become double."""
    df = df.withColumns({c: C.number(df, c) for c in present(df, config.DERIVED_NUMERIC)})
    rules = {
        "age": lambda c: C.in_range(c, *config.AGE_RANGE),
        "gross_amount": lambda c: F.when(c >= 0, c),
        "purchase_freq": lambda c: C.at_least(c, 1.0),
        "is_weekend": C.true_or_false,
        "amount_segment": lambda c: C.in_domain_or(
            c, [config.SEGMENT_LOW, config.SEGMENT_MIDDLE, config.SEGMENT_HIGH], config.SEGMENT_UNKNOWN),
    }
    return df.withColumns({c: rules[c](F.col(c)) for c in present(df, rules)})


def rule_violations(df):
    """(rule, violations) for all base rules in one pass over the coerced frame.

    A null is no range violation, but it fails the domain and the pattern.
    """
    df = coerce_numeric(df)
    low, high = config.DISCOUNT_RANGE
    checks = {
        "discount_pct": ("discount_pct_range", lambda c: (c < low) | (c > high)),
        "gender": ("gender_domain", lambda c: c.isNull() | ~c.isin(config.GENDERS)),
        "customer_id": ("customer_id_pattern", lambda c: C.matching(c).isNull()),
    }
    found = present(df, checks)
    counts = df.agg(*[F.count_if(checks[c][1](F.col(c))).alias(checks[c][0]) for c in found])
    return counts.unpivot([], counts.columns, "rule", "violations")


def drop_null_rows(df, columns):
    return df.na.drop(subset=present(df, columns))


def replace_infinite(df, columns):
    return df.withColumns({c: C.finite(F.col(c)) for c in present(df, columns)})


# ---- profiles ---------------------------------------------------------------------------

def null_profile(df, columns=None):
    """(variable, nulls, pct) for all columns in one aggregation."""
    columns = present(df, columns or df.columns)
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot(["_rows"], columns, "variable", "nulls")
    return long.select("variable", "nulls", _pct(F.col("nulls"), F.col("_rows")).alias("pct"))


def null_profile_groups(df, groups=None):
    """The null profile with the group (numeric, date, text) of each column."""
    groups = groups or config.NULL_PROFILE_GROUPS
    listed = {g: present(df, cols) for g, cols in groups.items()}
    profile = null_profile(df, [c for cols in listed.values() for c in cols])
    group = F.coalesce(*[F.when(F.col("variable").isin(cols), g) for g, cols in listed.items()])
    return profile.select(group.alias("column_group"), "variable", "nulls", "pct")


def row_digest(columns):
    """128 bits of a row's values, nulls told from other values."""
    given = [F.col(f"`{c}`") for c in columns]
    absent = F.concat_ws("", *[F.when(c.isNull(), "1").otherwise("0") for c in given])
    return F.struct(F.xxhash64(F.lit(1), absent, *given).alias("d1"), F.xxhash64(F.lit(2), *given, absent).alias("d2"))


def duplicate_count(df, columns=None, wide=WIDE_COLUMNS):
    """One row: rows beyond the first of each identical set. Nulls equal each other.

    Rows of more than ``wide`` columns are counted by a digest of 16 bytes first; whole rows are only compared, by grouping them, where
    a digest occurs again. A digest that very many rows share is not joined in one task.
    """
    columns = list(columns or df.columns)
    rows = df.select(*[F.col(f"`{c}`") for c in columns])
    if len(columns) > wide:
        marked = rows.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), row_digest(columns).alias("digest")).select("row", "digest.*")
        again = materialize(marked.groupBy("d1", "d2").agg(F.count("*").alias("n")).where("n > 1"))
        if again.isEmpty():  # no two rows can agree, so the rows needn't be read again
            return again.agg(F.count("*").alias("duplicates"))
        rows = attach_by_key(marked, again, ["d1", "d2"], "n").where("n IS NOT NULL").select("row.*")
    copies = rows.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def missing_columns(df, expected=None):
    """(stage, variable, present, consequence): the optional columns of each stage, and what is left out without them."""
    expected = expected or config.EXPECTED
    rows = [(stage, c, lost) for stage, columns in expected.items() for c, lost in columns.items()]
    wanted = df.sparkSession.createDataFrame(rows, "stage STRING, variable STRING, lost STRING")
    # The schema of the frame, one row for each column; nothing of the frame is read.
    schema = df.sparkSession.createDataFrame([(c,) for c in df.columns], "variable STRING").withColumn("found", F.lit(True))
    present_ = F.coalesce("found", F.lit(False))
    return wanted.join(F.broadcast(schema), "variable", "left").select(
        "stage", "variable", present_.alias("present"), F.when(~present_, F.concat(F.lit("left out: "), F.col("lost"))).alias("consequence"))


def type_table(df):
    """(variable, dtype, non_null): declared type and how many rows have a value."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot([], counts.columns, "variable", "non_null")
    dtype = F.coalesce(*[F.when(F.col("variable") == c, t) for c, t in df.dtypes])
    return long.select("variable", dtype.alias("dtype"), "non_null")


def column_role(field, codes=config.CODES):
    """numeric, categorical or temporal, by type; code columns count as categorical."""
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DayTimeIntervalType)):
        return "temporal"
    if isinstance(field.dataType, T.NumericType) and field.name not in codes:
        return "numeric"
    return "categorical"


def numeric_columns(df, columns=None):
    return [f.name for f in df.schema
            if (columns is None or f.name in columns) and column_role(f) == "numeric"]


def column_roles(df):
    """(variable, role, n_values): how each column is treated, with its exact number of different values.

    Counted per column from a table of (column, value), which is folded before it is shuffled. Whole and real numbers travel as
    such, others as text, and a column by its place: a shuffled row has few bytes.
    """
    whole, real = (T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType)
    cells = []
    for i, f in enumerate(df.schema):
        c, none = F.col(f"`{f.name}`"), F.lit(None)
        is_whole, is_real = isinstance(f.dataType, whole), isinstance(f.dataType, real)
        # The text tells the two zeros of a real number apart.
        text = none if is_whole else F.when(c == 0, c.cast("string")) if is_real else c
        cells.append(F.struct(F.lit(i).alias("place"), (c if is_whole else none).cast("bigint").alias("whole"),
                              (c if is_real else none).cast("double").alias("real"), text.cast("string").alias("text")))
    different = df.select(F.explode(F.array(*cells)).alias("_v")).select("_v.*").distinct()
    given = F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("text").isNotNull()
    counts = different.groupBy("place").agg(F.count_if(given).alias("n_values"))
    names = F.array(*[F.lit(f.name) for f in df.schema])
    roles = F.array(*[F.lit(column_role(f)) for f in df.schema])
    return counts.select(F.get(names, F.col("place")).alias("variable"), F.get(roles, F.col("place")).alias("role"), "n_values")


def missingness_mechanism(df, targets=config.MISSINGNESS_TARGETS, probes=config.MISSINGNESS_PROBES):
    """Do rows that lack a target differ in the probes? One aggregation over all pairs.

    (target, nulls, pct, probe, mean_missing, mean_present, relative_difference, not_mcar);
    pairs without both means, or with a zero reference mean, are left out.
    """
    targets, probes = present(df, targets), present(df, probes)
    pairs = [(t, p) for t in targets for p in probes if t != p]
    df = df.select(*[F.col(t).isNull().alias(f"no_{t}") for t in targets],
                   *[C.number(df, p).alias(p) for p in probes])
    aggregates = [F.count("*").alias("rows")]
    aggregates += [F.count_if(F.col(f"no_{t}")).alias(f"nulls_{t}") for t in targets]
    for t, p in pairs:
        aggregates.append(F.avg(F.when(F.col(f"no_{t}"), F.col(p))).alias(f"{t}|{p}|missing"))
        aggregates.append(F.avg(F.when(~F.col(f"no_{t}"), F.col(p))).alias(f"{t}|{p}|present"))
    one = df.agg(*aggregates)
    rows = F.array(*[F.struct(
        F.lit(t).alias("target"), F.col(f"nulls_{t}").alias("nulls"),
        _pct(F.col(f"nulls_{t}"), F.col("rows")).alias("pct"), F.lit(p).alias("probe"),
        F.col(f"`{t}|{p}|missing`").alias("mean_missing"),
        F.col(f"`{t}|{p}|present`").alias("mean_present")) for t, p in pairs])
    found = one.select(F.explode(rows).alias("r")).select("r.*").where(
        "nulls > 0 AND mean_missing IS NOT NULL AND mean_present <> 0")
    difference = F.abs(F.col("mean_missing") - F.col("mean_present")) / F.abs("mean_present")
    return found.withColumn("relative_difference", difference).withColumn(
        "not_mcar", F.col("relative_difference") > config.MISSINGNESS_SIGNAL)


class StageLog:
    """Row and column counts of stages as a by-product of writing them: the write observes its rows, no pass is added."""

    def __init__(self, spark):
        self.spark, self.stages = spark, []

    def write(self, name, df):
        """The frame written to the shared folder (see ``materialize``), logged under a name."""
        seen = Observation(name)
        written = materialize(df.observe(seen, F.count(F.lit(1)).alias("n_rows")))
        self.stages.append((name, seen.get["n_rows"], len(df.columns)))
        return written

    def table(self):
        """(stage, n_rows, n_columns) of the stages so far."""
        return self.spark.createDataFrame(self.stages, "stage STRING, n_rows BIGINT, n_columns BIGINT")


def stage_metrics(stages):
    """(stage, n_rows, n_columns) for {stage name: frame}, written one after the other."""
    log = StageLog(next(iter(stages.values())).sparkSession)
    for name, df in stages.items():
        log.write(name, df)
    return log.table()


def _pct(part, total):
    return F.when(total > 0, part / F.nullif(total, F.lit(0)) * 100).otherwise(0.0)


# ---- outliers ---------------------------------------------------------------------------

def fit_iqr(df, columns=config.NUMERIC):
    """{column: (q1, q3, lower, upper)}; columns without data or without spread are left out."""
    columns = present(df, columns)
    found = order_stats.fit_quantiles(df, columns, [0.25, 0.75])
    bounds = {}
    for c in columns:
        q1, q3 = (found.get((c, p), (None, 0))[0] for p in (0.25, 0.75))
        if q1 is not None and q3 > q1:
            reach = (q3 - q1) * config.IQR_FACTOR
            bounds[c] = (q1, q3, q1 - reach, q3 + reach)
    return bounds


def iqr_bounds(df, columns=config.NUMERIC):
    """(variable, q1, q3, lower, upper)"""
    return df.sparkSession.createDataFrame([(c, *b) for c, b in fit_iqr(df, columns).items()],
                                           "variable STRING, q1 DOUBLE, q3 DOUBLE, lower DOUBLE, upper DOUBLE")


def iqr_outlier_counts(df, columns=config.NUMERIC):
    """(variable, lower, upper, outliers, pct of all rows)."""
    columns = present(df, columns)
    bounds = fit_iqr(df, columns)
    listed = [c for c in columns if c in bounds]
    one = df.agg(F.count("*").alias("rows"),
                 *[F.count_if(~C.number(df, c).between(*bounds[c][2:])).alias(c) for c in listed])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.lit(bounds[c][2]).alias("lower"),
                              F.lit(bounds[c][3]).alias("upper"), F.col(c).alias("outliers"),
                              _pct(F.col(c), F.col("rows")).alias("pct")) for c in listed])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def iqr_null_outliers(df, columns=config.NUMERIC, passes=1):
    """Values outside the IQR bounds become null; rows stay. Each pass fits new bounds."""
    for _ in range(passes):
        bounds = fit_iqr(df, columns)
        df = df.withColumns({c: C.in_range(F.col(c), *bounds[c][2:]) for c in present(df, columns) if c in bounds})
    return df


# ---- tiered null policy -----------------------------------------------------------------

def null_policy_plan(df, columns):
    """(position, variable, nulls, pct, action): what the share of nulls calls for, per column."""
    columns = present(df, columns)
    action = (F.when(F.col("nulls") == 0, "keep")
              .when(F.col("pct") <= config.DROP_ROWS_UP_TO_PCT, "drop_rows")
              .when(F.col("pct") <= config.IMPUTE_UP_TO_PCT, "impute")
              .otherwise("drop_column"))
    position = F.coalesce(*[F.when(F.col("variable") == c, i) for i, c in enumerate(columns)])
    return null_profile(df, columns).select(
        position.cast("bigint").alias("position"), "variable", "nulls", "pct", action.alias("action"))


def apply_null_policy(df, columns):
    """Drop rows, impute or drop columns by their share of nulls.

    Shares are fixed up front. Columns are handled in order, so an imputed value is computed
    on the rows left by the columns before it: all of them come from one conditional pass.
    """
    if not present(df, columns):
        return df
    plan = [(r["variable"], r["action"]) for r in null_policy_plan(df, columns).orderBy("position").collect()]
    kept, numeric, other = F.lit(True), {}, {}
    for name, action in plan:
        if action == "drop_rows":
            kept = kept & F.col(name).isNotNull()
        elif action == "impute":
            is_number = isinstance(df.schema[name].dataType, T.NumericType)
            (numeric if is_number else other)[name] = kept
    medians = order_stats.medians(df, list(numeric), numeric)
    # One column at a time: each has its own rows. The most frequent value comes back as text.
    modes = {name: order_stats.modes(df.where(rows), [name]).first() for name, rows in other.items()}
    df = df.na.drop(subset=[n for n, a in plan if a == "drop_rows"]) if any(
        a == "drop_rows" for _, a in plan) else df
    filled = {n: F.coalesce(C.number(df, n), F.lit(v)) for n, v in medians.items() if v is not None}
    filled |= {n: F.coalesce(F.col(n), F.lit(r["mode"]).cast(df.schema[n].dataType))
               for n, r in modes.items() if r is not None}
    return df.withColumns(filled).drop(*[n for n, a in plan if a == "drop_column"])


def clean_base(df, columns=config.NUMERIC, passes=2):
    """Outliers to null (the reference trims twice), then the null policy on the base columns."""
    return apply_null_policy(iqr_null_outliers(df, columns, passes), columns)


def impute_median(df, columns):
    found = order_stats.medians(df, present(df, columns))
    return df.withColumns({c: F.coalesce(C.number(df, c), F.lit(v)) for c, v in found.items()})


def impute_mode(df, columns):
    """Nulls become the column's most frequent value (the smallest on ties)."""
    found = order_stats.modes(df, present(df, columns)).collect()
    return df.withColumns({r["variable"]: F.coalesce(
        F.col(r["variable"]), F.lit(r["mode"]).cast(df.schema[r["variable"]].dataType)) for r in found})
