"""Column expressions: coercion, domain rules and IEEE arithmetic. All stay inside codegen."""

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from basketlens import config

INF = float("inf")


def number(df, name):
    """Column as double; malformed text and NaN become null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        text = F.trim(F.col(name))
        # Java accepts a type suffix ("1.5d"); that is not a number here.
        value = F.when(~text.rlike("[0-9.][dDfF]$"), text.try_cast("double"))
    else:
        value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def timestamp(df, name):
    """Column as timestamp; malformed text becomes null, date and time types pass through."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("timestamp_ntz")
    return F.col(name)


def in_range(value: Column, low, high) -> Column:
    return F.when(value.between(low, high), value)


def in_domain(value: Column, allowed) -> Column:
    return F.when(value.isin(list(allowed)), value)


def in_domain_or(value: Column, allowed, sentinel) -> Column:
    return F.when(value.isin(list(allowed)), value).otherwise(F.lit(sentinel))


def matching(value: Column, pattern=config.UUID_PATTERN) -> Column:
    """Lower-cased text, null unless it matches the pattern."""
    text = F.lower(value)
    return F.when(text.rlike(pattern), text)


def at_least(value: Column, low) -> Column:
    """Values below the minimum and nulls become the minimum."""
    return F.when(value >= low, value).otherwise(F.lit(low))


def true_or_false(value: Column) -> Column:
    return F.coalesce(value.cast("boolean"), F.lit(False))


def finite(value: Column) -> Column:
    """Infinities and NaN become null (NaN compares greater than every number in Spark)."""
    return F.when(F.abs(value) < F.lit(INF), value)


def ieee_divide(a: Column, b: Column) -> Column:
    """a / b where x/0 is an infinity with the sign of x and 0/0 is missing."""
    by_zero = F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))
    return F.when(b == 0, by_zero).otherwise(a / F.nullif(b, F.lit(0.0)))
