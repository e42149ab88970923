"""Running sums within groups of any size, and bounded samples, without sending a group to one task."""

from pyspark.sql import Window, functions as F

from basketlens.sources.staging import materialize


def running_totals(df, group, order, value):
    """The rows with ``position`` (from 0) and ``before``, the sum of ``value`` before the row, within the group.

    One distributed sort by group and order (equal rows in any order), written once with each row's
    place. A window then runs within (file part, group), so a group that holds a third of all rows
    is as wide as the sort spread it, and one row per part and group carries the sums across parts.
    """
    placed = materialize(df.withColumn("_tie", F.monotonically_increasing_id())
                         .orderBy(group, *order, "_tie").drop("_tie")
                         .withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    earlier = Window.partitionBy("_part", group).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    local = (placed.withColumn("_rows", F.count("*").over(earlier))
             .withColumn("_sum", F.coalesce(F.sum(value).over(earlier), F.lit(0))))
    parts = placed.groupBy("_part", group).agg(F.count("*").alias("n"), F.sum(value).alias("s"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col("_part").alias("_p"), F.col(group).alias("_g"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"),
                           F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_s")).where("_n > 0")
    same = (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    return (local.join(offsets, same, "left")
            .withColumn("position", F.col("_rows") + F.coalesce("_n", F.lit(0)))
            .withColumn("before", F.col("_sum") + F.coalesce("_s", F.lit(0)))
            .select(*[c for c in df.columns], "position", "before"))


def bounded_sample(df, key, most, seed):
    """At most ``most`` rows, chosen by a hash of a key column; all rows where there are no more.

    A threshold on the hash leaves somewhat fewer rows, whatever the layout of the table; only where many rows share a
    key can there be more, and then the smallest hashes are taken.
    """
    total = df.count()
    if total <= most:
        return df
    place = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30))
    # Five deviations of a sample of this size below the bound.
    drawn = df.where(place < int((1 << 30) * max(0.5 * most, most - 5 * most ** 0.5) / total))
    return drawn if drawn.count() <= most else drawn.orderBy(place, *df.columns).limit(most)
