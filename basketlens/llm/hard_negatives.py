"""Hard negatives by a secondary-sort shuffle.

Every anchor is scored against every row of its vector length, in blocks of rows and of anchors that are one task's
work each. Pairs are packed into keys of (anchor, descending score, kind, id), which
``repartitionAndSortWithinPartitions`` brings into order; an iterator then walks each anchor's pairs from the best
down. A positive opens a window of scores, a negative is handed to every window that covers its score, and a window
closes when it has its negatives or the scores have fallen below it. No anchor's pairs are ever held together.

A block's task packs only pairs that can count: of the same label its first ``positives``; once these are known for
all blocks, of the other labels its first ``negatives`` of every window. So the shuffles carry at most a fixed number
of pairs for each anchor and block, and the result is the same as with all of them.

Scores are integer inner products, computed exactly (in doubles where every partial sum is one, else as integers).

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part. Vectors of
different lengths have no score; an empty vector scores 0. Equal rows are one with a count: each copy counts as a
row of its own, as anchor, positive and negative, and an anchor is no partner of itself but of its copies. Rows with one
id and different vectors or labels are different rows. A null id is never an anchor and comes after all others in ties.
Components and scores beyond 64 bits are held at their ends. Other columns are ignored. An empty table, or one without
anchors, gives no rows.
"""

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketlens.llm.registry import query, table
from basketlens.sources.staging import materialize

BLOCK_VALUES = 4 << 20  # vector components of one block of rows
LEAST_BLOCK = 1_024
SCORES_AT_ONCE = 2 << 20
PAIRS_A_TASK = 500_000
KEY = ">QQBBQQ"  # anchor, descending score, kind, id is null, id, row
KEY_TYPE = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("absent", "u1"), ("id", ">u8"), ("row", ">u8")])
POSITIVE, NEGATIVE = 0, 1
MOST = (1 << 63) - 1
BIAS = 1 << 63
PAIRS = "key BINARY, copies BIGINT"
RESULT = ("anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT, positive_score BIGINT, "
          "negative_score BIGINT")


def quantised(embeddings, id_column="vec_id", vector_column="embedding", label_column="label", scale=256):
    """(vec_id, label, q) of the usable rows: every component is floor(scale · x) of x as a double."""
    vector = F.col(vector_column)
    usable = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return embeddings.where(F.col(label_column).isNotNull() & vector.isNotNull() & usable).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("q"))


# ---- scores of a block --------------------------------------------------------------------

def inner_products(x, e):
    """Exact integer inner products of the rows of x with those of e, as 64-bit integers."""
    widest = (lambda m: max(abs(int(m.max())), abs(int(m.min()))) if m.size else 0)
    bound = widest(x) * widest(e) * x.shape[1]
    if bound < 1 << 53:
        return (x.astype(float) @ e.astype(float).T).astype(np.int64)
    if bound <= MOST:
        return x @ e.T
    return np.clip(x.astype(object) @ e.astype(object).T, -MOST, MOST).astype(np.int64)


def first_of(values, k):
    """Places of the k greatest values, greatest first, ties to the lower place."""
    if values.size > k:
        kth = np.partition(values, values.size - k)[values.size - k]
        above = np.flatnonzero(values > kth)
        chosen = np.concatenate([above, np.flatnonzero(values == kth)[:k - above.size]])
    else:
        chosen = np.arange(values.size)
    return chosen[np.lexsort((chosen, -values[chosen]))]


def window(score, low, high):
    """Least and greatest integer n with low · score <= 100 · n <= high · score."""
    return -(-low * score // 100), high * score // 100


def pack(anchor, score, kind, ids, absent, rows):
    keys = np.empty(len(rows), KEY_TYPE)
    keys["anchor"], keys["kind"], keys["absent"], keys["row"] = anchor, kind, absent, rows
    keys["score"] = np.uint64(MOST) - score.astype(np.uint64)  # wraps, so that smaller scores are greater keys
    keys["id"] = ids.astype(np.uint64) + np.uint64(BIAS)
    return keys.view(f"V{KEY_TYPE.itemsize}")  # concatenation would change the byte order of numbers


def unpack(key):
    """(anchor, kind, score, id) of a packed key."""
    anchor, falling, kind, absent, biased, _ = struct.unpack(KEY, key)
    return anchor, kind, MOST - falling, None if absent else biased - BIAS


def _matrix(column, dims):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _score_blocks(choose, kind):
    """A function of (rows, anchors) of one block that packs the pairs whose places ``choose`` names.

    ``choose`` gets an anchor's scores in tie order, its label's places, the numbers of copies and the anchor's row.
    """
    def run(rows, anchors):
        if not rows.num_rows or not anchors.num_rows:
            return pa.table({"key": pa.array([], pa.binary()), "copies": pa.array([], pa.int64())})
        dims = rows["dims"][0].as_py()
        absent = rows["vec_id"].is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
        ids, numbers = rows["vec_id"].fill_null(0).to_numpy(), rows["row"].to_numpy()
        order = np.lexsort((numbers, ids, absent))
        ids, numbers, absent = ids[order], numbers[order], absent[order]
        copies, labels = rows["copies"].to_numpy()[order], rows["label"].to_numpy()[order]
        e, x = _matrix(rows["q"], dims)[order], _matrix(anchors["q"], dims)
        same = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
        place = {row: i for i, row in enumerate(numbers.tolist())}
        packed, counts = [], []
        owners = anchors.drop_columns(["q"]).to_pylist()
        step = max(1, SCORES_AT_ONCE // max(1, e.shape[0]))
        for low in range(0, len(owners), step):
            scores = inner_products(x[low:low + step], e)
            for owner, values in zip(owners[low:low + step], scores):
                mine = same.get(owner["label"], np.empty(0, np.int64))
                itself = place.get(owner["row"])
                if itself is not None:
                    copies[itself] -= 1
                at = choose(owner, values, mine, copies)
                packed.append(pack(owner["row"], values[at], kind, ids[at], absent[at], numbers[at]))
                counts.append(copies[at])
                if itself is not None:
                    copies[itself] += 1
        keys, counts = np.concatenate(packed), np.concatenate(counts)
        bounds = pa.py_buffer((np.arange(keys.size + 1, dtype=np.int32) * keys.itemsize).tobytes())
        column = pa.Array.from_buffers(pa.binary(), keys.size, [None, bounds, pa.py_buffer(keys.tobytes())])
        return pa.table({"key": column, "copies": pa.array(counts, pa.int64())})
    return run


def _first_same(k):
    def choose(owner, values, mine, copies):
        others = mine[copies[mine] > 0]
        return others[first_of(values[others], k)]
    return choose


def _first_in_windows(k, low, high):
    def choose(owner, values, mine, copies):
        windows = [window(p, low, high) for p in owner["scores"]]
        inside = (values >= min(a for a, _ in windows)) & (values <= max(b for _, b in windows))
        inside[mine] = False
        near = np.flatnonzero(inside)
        found = values[near]
        chosen = []
        for a, b in windows:
            fits = np.flatnonzero((found >= a) & (found <= b))
            chosen.append(near[fits[first_of(found[fits], k)]])
        return np.unique(np.concatenate(chosen))
    return choose


# ---- the shuffle and the walk ---------------------------------------------------------------

def in_key_order(pairs, partitions):
    """An RDD of (key, …) records: an anchor's in one partition, in the order of their keys."""
    def partition_of(key):
        return (int.from_bytes(key[:8], "big") * 0x9E3779B97F4A7C15 >> 32) % partitions

    records = pairs.rdd.map(lambda r: (bytes(r[0]), tuple(r[1:])))
    return records.repartitionAndSortWithinPartitions(partitions, partition_of)


def _take_positives(k):
    def run(records):
        current, taken = None, 0
        for key, (copies,) in records:
            anchor, _, score, _ = unpack(key)
            if anchor != current:
                current, taken = anchor, 0
            if taken < k:
                yield key, copies, anchor, score
                taken += copies
    return run


def _walk(positives, negatives, low, high):
    """Rows of the result, with the anchor's number of copies, from one partition's records in order."""
    def run(records):
        current, opened, windows = None, 0, []
        for key, (copies, anchor_id, times) in records:
            anchor, kind, score, found = unpack(key)
            if anchor != current:
                current, opened, windows = anchor, 0, []
            if kind == POSITIVE:
                new = min(copies, positives - opened)
                opened += new
                windows.extend([found, score, 0, anchor_id, times] for _ in range(new))
                continue
            # Scores only fall, so a window that is full or passed never takes another.
            windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
            for w in windows:
                if 100 * score <= high * w[1]:
                    for _ in range(min(copies, negatives - w[2])):
                        w[2] += 1
                        for _ in range(w[4]):
                            yield w[3], w[0], w[2], found, w[1], score
    return run


def mine(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``quantised`` rows.

    ``is_anchor`` is a condition on ``vec_id``. An anchor's positives are its first ``positives`` other rows of its
    label; each gets the first ``negatives`` rows of other labels whose score is between ``low`` and ``high`` percent of its own.
    """
    spark = rows.sparkSession
    folded = materialize(rows.groupBy("vec_id", "label", "q").agg(F.count("*").alias("copies"))
                         .select(F.monotonically_increasing_id().alias("row"), F.size("q").alias("dims"), "*"))
    chosen = F.coalesce(is_anchor, F.lit(False))
    size = folded.agg(F.count("*").alias("n"), F.count_if(chosen).alias("anchors"), F.avg("dims").alias("dims")).first()
    if not size["anchors"]:
        return spark.createDataFrame([], RESULT)
    cores = spark.sparkContext.defaultParallelism
    widest = max(LEAST_BLOCK, int(BLOCK_VALUES / max(1.0, size["dims"])))
    block_rows = min(widest, max(LEAST_BLOCK, -(-size["n"] // cores)))
    n_blocks, n_anchor_blocks = -(-size["n"] // block_rows), -(-size["anchors"] // widest)

    def number(n):
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    group = ["dims", "block", "anchors"]
    dealt = folded.select("*", number(n_blocks).alias("block")).select("*", each(n_anchor_blocks).alias("anchors"))
    anchors = materialize(folded.where(chosen))
    partitions = max(cores, -(-size["anchors"] * n_blocks * positives * (negatives + 1) // PAIRS_A_TASK))

    def pairs(asking, choose, kind):
        asking = asking.select("*", number(n_anchor_blocks).alias("anchors")).select("*", each(n_blocks).alias("block"))
        return (dealt.groupBy(*group).cogroup(asking.groupBy(*group))
                .applyInArrow(_score_blocks(choose, kind), PAIRS))

    same = pairs(anchors.select("row", "dims", "label", "q"), _first_same(positives), POSITIVE)
    found = materialize(spark.createDataFrame(
        in_key_order(same, partitions).mapPartitions(_take_positives(positives)),
        "key BINARY, copies BIGINT, anchor BIGINT, score BIGINT", verifySchema=False))
    # At most ``positives`` scores for each anchor.
    scores = found.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("scores"))
    asking = anchors.join(scores, "row").select("row", "dims", "label", "q", "scores")
    other = pairs(asking, _first_in_windows(negatives, low, high), NEGATIVE)
    owners = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.col("copies").alias("times"))
    opening = found.join(owners, "anchor").select("key", "copies", "anchor_id", "times")
    none = F.lit(None).cast("long")
    walked = opening.union(other.select("key", "copies", none, none))
    return spark.createDataFrame(
        in_key_order(walked, partitions).mapPartitions(_walk(positives, negatives, low, high)), RESULT, verifySchema=False)


OP12_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark, sf_dir):
    rows = quantised(table(spark, sf_dir, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)
