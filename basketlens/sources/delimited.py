"""Delimited text in, small reports and result tables out."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens import config

SALES_COLUMNS = ["sku", "units", "discount_pct", "amount", "receipt_id", "store", "gender",
                 "customer_id", "ts", "birth_date", "channel", "product", "first_name",
                 "last_name", "customer_run"]


def text_schema(columns):
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def scan_delimited(spark, path, columns=None, sep=";", header=True, bad=None):
    """Lazy scan of delimited files; every field is text until it is validated.

    With ``columns`` there is no inference job and only the header is skipped. Split size is
    ``spark.sql.files.maxPartitionBytes``. ``bad`` names a further text column that holds a malformed line as it is (too few
    or too many fields, a quote that never ends) and is null otherwise; whole lines are parsed for it, whatever columns are read.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("enforceSchema", True)
    if bad is not None:
        if columns is None:
            raise ValueError("malformed lines can only be told by the expected columns")
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).option("columnPruning", False)
        columns = [*columns, bad]
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    return reader.csv(path)


def line_report(scanned, bad, more=None):
    """(file, n_lines, n_bad) of a scan with a column of malformed lines, and further aggregates by name."""
    extra = [a.alias(name) for name, a in (more or {}).items()]
    # Spark doesn't read the column of malformed lines without any other.
    other = next(c for c in scanned.columns if c != bad)
    malformed = F.concat(F.col(bad), F.coalesce(F.col(other), F.lit("")))
    return scanned.select("*", F.col("_metadata.file_path").alias("file")).groupBy("file").agg(
        F.count("*").alias("n_lines"), F.count(malformed).alias("n_bad"), *extra)


def parse_delimited(df, line, columns, sep=";"):
    """Parse a column of delimited lines into text fields."""
    ddl = ", ".join(f"{c} STRING" for c in columns)
    return df.select(F.from_csv(line, ddl, {"sep": sep}).alias("r")).select("r.*")


def write_table(df, path, mode="errorifexists"):
    """Result table as CSV with a header, one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parameters(params, path, mode="errorifexists"):
    """Scaling parameters (column, mean, std) as JSON."""
    params.write.mode(mode).json(path)


def read_parameters(spark, path):
    return spark.read.schema("column STRING, mean DOUBLE, std DOUBLE").json(path)


def write_report(lines, path, mode="errorifexists"):
    """A one-column frame of report lines as text."""
    lines.write.mode(mode).text(path)


def write_clusters(assigned, path, mode="errorifexists"):
    """Customers with their cluster; parquet, because the table grows with the customers."""
    assigned.write.mode(mode).parquet(path)


def table_shape(df):
    """One row: number of rows and columns, and how many input partitions hold rows."""
    parts = df.select(F.spark_partition_id().alias("part")).groupBy("part").agg(F.count("*").alias("n"))
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_partitions")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "n_partitions")


def _smallest(df, order, n, sketch_error=1e-3):
    """About the first n rows by a leading order column, and never fewer: what is left to sort is near n.

    A quantile sketch of the leading column gives a bound a little above the n-th row; a count proves it. A top-n
    of the whole frame would send up to n rows of every partition to one task.
    """
    total = df.count()
    if total <= 2 * n:
        return df
    lead = order[0]
    share = n / total
    while True:
        share = min(1.0, share + 2 * sketch_error)
        bound = df.agg(F.percentile_approx(lead, F.lit(share), F.lit(int(1 / sketch_error) * 10)).alias("b")).first()["b"]
        chosen = df.where((F.col(lead) <= F.lit(bound)) | F.col(lead).isNull())
        if share >= 1.0 or bound is None or chosen.count() >= n:
            return df if bound is None else chosen
        share *= 2


def head_sample(df, order_by=None, n=config.HEAD_ROWS, columns=None):
    """The first n rows by the given order (default: all columns), so the head is repeatable.

    Rows beyond a sketched bound of the first (numeric or temporal) order column are filtered out before the sort.
    """
    columns = columns or df.columns
    order = list(order_by or df.columns)
    lead = df.schema[order[0]].dataType if isinstance(order[0], str) else None
    if isinstance(lead, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        df = _smallest(df, order, n)
    return df.orderBy(*order).limit(n).select(*columns)


def seeded_sample(df, key, n, seed=config.SEED):
    """Exactly n rows (fewer if there are fewer), chosen by a hash of a key and a seed.

    The hash is uniform, so the rows below n / total of its range, and a margin, hold the n smallest; a
    count proves it. Only they are sorted.
    """
    draw = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    drawn = df.withColumn("_draw", draw)
    total, margin = df.count(), 1.2
    while n < total:
        limit = min(1.0, margin * n / total + 100 / total)
        if limit >= 1.0:
            break
        some = drawn.where(F.conv(F.substring("_draw", 1, 12), 16, 10).cast("double") < limit * 16.0 ** 12)
        if some.count() >= n:
            drawn = some
            break
        margin *= 2
    return drawn.orderBy("_draw", *key).limit(n).drop("_draw")
