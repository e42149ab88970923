"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join; labels and links stay distributed. Each round is
checkpointed to the shared folder, so lineage stays short and a lost executor costs only its
running tasks. The number of rounds grows with the logarithm of the longest path.
"""

from pyspark.sql import functions as F

from basketlens.sources.staging import checkpoint


def _stars(links, larger_only):
    """Each node's smallest neighbour (or itself), attached to the node's links."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = links.join(least, "u")
    return joined.where("v > u") if larger_only else joined


def components(links, left="a", right="b"):
    """(node, root) for every node with a link to another; root is the smallest node reachable."""
    spark = links.sparkSession
    edges = (links.select(F.col(left).alias("u"), F.col(right).alias("v"))
             .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    edges = checkpoint(edges)
    if edges.isEmpty():
        return spark.createDataFrame([], "node BIGINT, root BIGINT")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_stars(both, larger_only=True).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # In a small star every link goes from the larger to the smaller node.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        edges = checkpoint(small)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
