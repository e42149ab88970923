"""Features derived from sales lines, and their standardization."""

from pyspark.sql import functions as F

from basketlens import config
from basketlens.config import present
from basketlens.functions import columns as C
from basketlens.operators import order_stats
from basketlens.operators.describe import per_column
from basketlens.operators.skew import attach_by_key


def amount_per_unit(amount="amount", units="units"):
    return C.ieee_divide(F.col(amount), F.col(units))


def age(birth_date="birth_date", reference_year=config.REFERENCE_YEAR):
    return F.lit(reference_year) - F.year(birth_date)


def full_days_between(earlier, later):
    """Whole 24-hour days, not calendar days."""
    return F.timestamp_diff("DAY", earlier, later)


def recency_days(df, ts="ts"):
    """Full days from each row to the latest row; the latest time is a scalar subquery."""
    return full_days_between(F.col(ts), df.agg(F.max(ts)).scalar())


def is_weekend(ts="ts"):
    return F.coalesce(F.weekday(ts) >= 5, F.lit(False))


def segment_cutoffs(df, column="amount", probabilities=config.SEGMENT_PROBABILITIES):
    """The two exact quantiles that separate the segments; two numbers reach the driver."""
    found = order_stats.fit_quantiles(df, [column], probabilities)
    return [found.get((column, float(p)), (None, 0))[0] for p in probabilities]


def segment(value, cutoffs):
    """Low, middle or high; a missing value counts as low."""
    low, high = [F.lit(c).cast("double") for c in cutoffs]
    return (F.when(value > high, config.SEGMENT_HIGH).when(value > low, config.SEGMENT_MIDDLE)
            .otherwise(config.SEGMENT_LOW))


def gross_amount(amount="amount", discount="discount_pct"):
    return C.ieee_divide(F.col(amount), 1 - F.col(discount))


def with_purchase_frequency(df, customer="customer_id", receipt="receipt_id", name="purchase_freq"):
    """Lines with a receipt per customer, on every line; null for lines without a customer."""
    known = df.where(F.col(customer).isNotNull()).groupBy(customer)
    table = known.agg(F.count(receipt).alias(name), F.count("*").alias("_lines"))
    return attach_by_key(df, table, [customer], "_lines").drop("_lines")


FEATURES = {
    "amount_per_unit": (["amount", "units"], lambda df: amount_per_unit()),
    "age": (["birth_date"], lambda df: age()),
    "hour": (["ts"], lambda df: F.hour("ts")),
    "recency_days": (["ts"], recency_days),
    "is_weekend": (["ts"], lambda df: is_weekend()),
    "amount_segment": (["amount"], lambda df: segment(F.col("amount"), segment_cutoffs(df))),
    "gross_amount": (["amount", "discount_pct"], lambda df: gross_amount()),
}
PURCHASE_FREQUENCY = ["customer_id", "receipt_id"]  # what purchase_freq comes from


def derive_features(df, only=config.DERIVED):
    """The wanted derived columns (default: all) whose inputs are present."""
    wanted = [c for c in FEATURES if c in only and not config.missing(df, FEATURES[c][0])]
    features = {c: FEATURES[c][1](df) for c in wanted}
    if "purchase_freq" in only and not config.missing(df, PURCHASE_FREQUENCY):
        # Counted and joined before the others are derived: what they come from has fewer bytes than they have.
        derived = with_purchase_frequency(df).withColumns(features)
        return derived.select(*[c for c in derived.columns if c != "purchase_freq"], "purchase_freq")
    return df.withColumns(features)


def needed_for(features):
    """The columns of the lines that the given derived columns come from."""
    inputs = [name for c in features if c in FEATURES for name in FEATURES[c][0]]
    return list(dict.fromkeys([*inputs, *(PURCHASE_FREQUENCY if "purchase_freq" in features else [])]))


# ---- standardization --------------------------------------------------------------------

def scaling_parameters(df, columns=config.SCALED, population=False):
    """(column, mean, std) for all columns in one aggregation; without spread: left out."""
    columns = present(df, columns)
    std = F.stddev_pop if population else F.stddev_samp
    long = per_column(df, columns, mean=F.avg, std=std).withColumnRenamed("variable", "column")
    return long.where((F.col("std") > 0) & ~F.isnan("std"))


def apply_scaling(df, parameters, suffix="_scaled"):
    """Add (x − mean) / std for each parameter row; the rows are one per column."""
    return df.withColumns({r["column"] + suffix: (C.number(df, r["column"]) - r["mean"]) / r["std"]
                           for r in parameters.collect() if r["column"] in df.columns})


def standardize(df, columns=config.SCALED):
    return apply_scaling(df, scaling_parameters(df, columns))
