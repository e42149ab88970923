"""Joins and numbering that hold when one key owns a large share of the rows."""

from pyspark.sql import Window, functions as F

from basketlens.sources.staging import discard, materialize, written_bytes

BROADCAST_BYTES = 8 << 20  # as written; a few times that in memory
HOT_KEYS = 1_000
SORTED_ROWS = 250_000  # of one task


def tasks_for(spark, rows):
    """As many tasks as leave each at most about ``SORTED_ROWS`` rows to sort, and no fewer than there are cores."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // SORTED_ROWS))


def attach_by_key(rows, table, keys, weight, broadcast_bytes=BROADCAST_BYTES, hot_keys=HOT_KEYS):
    """Left join a per-key table onto its rows without sending a hot key to one task.

    ``table`` has one row per key and ``weight`` says how many rows that key owns. It is written
    once: up to ``broadcast_bytes`` of files it is broadcast. Beyond that the ``hot_keys``
    heaviest keys are broadcast (a fixed number, whatever the data size); any other key then
    owns less than 1/hot_keys of the rows and goes through a shuffle join. Rows already served,
    and rows with a null key, take a salt of their own in that join, so they spread over all
    tasks and match nothing.
    """
    table = materialize(table)
    if written_bytes(table) <= broadcast_bytes:
        return rows.join(F.broadcast(table), keys, "left").select(
            *rows.columns, *[c for c in table.columns if c not in keys])
    payload = [c for c in table.columns if c not in keys]
    hot = (table.orderBy(F.desc(weight), *keys).limit(hot_keys)
           .select(*keys, F.struct(*payload).alias("_hot")))
    cold = table.select(*keys, F.struct(*payload).alias("_cold"), F.lit(0).cast("long").alias("_salt"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    served = F.col("_hot").isNotNull() | null_key
    salted = (rows.join(F.broadcast(hot), keys, "left")
              .withColumn("_salt", F.when(served, F.monotonically_increasing_id() + 1).otherwise(0)))
    joined = salted.join(cold, [*keys, "_salt"], "left")
    match = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[match[c].alias(c) for c in payload])


def with_row_number(df, order_by, name="row_number"):
    """Consecutive 1-based numbers in a total order, without a single-task window.

    The rows are written first, as the sort reads them twice (its ranges are sampled) and their number sets its tasks, so that
    a task's memory doesn't grow with the table. Then one distributed sort, written once with each row's partition and place in it;
    a count per partition gives each partition its offset. Identical rows are told apart by
    their scan position, so a large group of copies also spreads over the sort partitions. What is sorted by may be
    columns or expressions of them; the latter are neither moved nor written.
    """
    return _numbered(df, order_by, name)[0]


def _numbered(df, order_by, name):
    """The numbered rows, and the tasks that sorted them."""
    tied = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), compact=True)
    tasks = tasks_for(df.sparkSession, tied.count())
    ranges = tied.repartitionByRange(tasks, *order_by, "_tie")
    placed = materialize(ranges.sortWithinPartitions(*order_by, "_tie").drop("_tie").withColumn("_id", F.monotonically_increasing_id()), compact=True)
    discard(tied)
    part = F.shiftright("_id", 33)
    place = F.col("_id").bitwiseAND((1 << 33) - 1)
    # One row per sort partition.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return (placed.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + place + 1)
            .drop("_id", "_part", "_offset")), tasks


def with_blocks(df, order_by, block_rows, name="block"):
    """Number blocks of exactly ``block_rows`` consecutive rows (the last may be shorter).

    Whole blocks are dealt to as many tasks as sorted the rows, so grouping by block needs no further shuffle.
    """
    numbered, tasks = _numbered(df, order_by, "_number")
    return numbered.withColumn(name, F.floor((F.col("_number") - 1) / block_rows)).drop("_number").repartition(tasks, name)
