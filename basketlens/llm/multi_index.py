"""Nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut into two halves, each with its own codebook, so that an entry lies in a cell (pair of
centroids) of a grid of ``CENTROIDS`` squared cells. A query sorts the centroids of both codebooks by distance and
walks the pairs in order of the summed distance with a heap, until the visited cells hold its share of
all entries (and never fewer than ``LEAST_CANDIDATES``). The entries of those cells are reranked by the exact cosine in
double precision on the original vectors.

The codebooks are fitted by Spark's K-Means on at most ``TRAIN_VECTORS`` vectors, chosen by a hash of the id; every vector
is indexed. Measured recall at the shipped parameters is in the README.

Cells with the same first centroid make a row of the grid. Its entries and the queries that visit it (each with its list of
second centroids) are dealt by hash into blocks of about ``BLOCK_ROWS``, and each pair of blocks is a task's group that returns
a few rows for each query. So one vector that a third of all rows share spreads over many tasks, and no pairs are listed.

Defined cases: vectors that are null, zero, hold null or non-finite components, or lack an id take no part; of several
lengths the most frequent counts (on ties the longer). Rows repeated are entries each, and copies of a neighbour fill a rank
each; they are folded to one row with a count before the search. A query row repeated asks once. With different vectors under a
query's id each of them asks, and every entry counts once, with its best score to any of them. A query isn't its own neighbour, and
neither is another row with its id. Fewer than ``k`` candidates give fewer rows. Other columns are ignored. An empty table gives
an empty table.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window, functions as F

from basketlens.llm.ordered import bounded_sample
from basketlens.llm.registry import query, table
from basketlens.sources.staging import materialize

CENTROIDS = 64
TRAIN_VECTORS = 20_000
CANDIDATE_SHARE = 0.45
LEAST_CANDIDATES = 1_000
BLOCK_ROWS = 4_096
RESULT = "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE"


def usable(vectors, id_column, vector_column):
    """(vec_id, vector) of the vectors that take part."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("ARRAY<DOUBLE>").alias("vector"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id is not null and vector is not null").where(F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return (rows if sizes is None else rows.where(F.size("vector") == sizes["d"])), (sizes["d"] if sizes else 0)


def fit_codebooks(rows, d, centroids=CENTROIDS, most=TRAIN_VECTORS, seed=42):
    """Two arrays of centroids, one for each half of the unit vectors."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    sample = materialize(bounded_sample(rows, "vec_id", most, seed)
                         .select(F.transform("vector", lambda x: x / norm).alias("unit")))
    cut = d // 2
    books = []
    for start, width in ((1, cut), (cut + 1, d - cut)):
        if not width:
            books.append(np.zeros((1, 0)))
            continue
        half = sample.select(array_to_vector(F.slice("unit", start, width)).alias("features"))
        books.append(np.array(KMeans(k=centroids, maxIter=15, seed=seed).fit(half).clusterCenters()))
    return books


def _matrix(column, d):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _distances(x, books):
    """Squared distances of the halves of unit vectors to the centroids of both books."""
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    cut = books[0].shape[1]
    return [((h * h).sum(axis=1)[:, None] - 2 * h @ b.T + (b * b).sum(axis=1)[None, :])
            for h, b in ((unit[:, :cut], books[0]), (unit[:, cut:], books[1]))]


def _assign(books, d):
    def run(batches):
        for batch in batches:
            one, two = _distances(_matrix(batch["vector"], d), books)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["key"], batch["copies"], pa.array(one.argmin(axis=1).astype(np.int32)),
                 pa.array(two.argmin(axis=1).astype(np.int32)), batch["vector"]], ["vec_id", "key", "copies", "first", "second", "vector"])
    return run


def walk(one, two, sizes, wanted):
    """Cells (first, second) in order of summed distance, until they hold ``wanted`` entries; empty cells are passed over."""
    first, second = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    heap, seen, held, cells = [(one[first[0]] + two[second[0]], 0, 0)], {(0, 0)}, 0, []
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(first[i]), int(second[j])
        if sizes.get(cell):
            cells.append(cell)
            held += sizes[cell]
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(one) and b < len(two) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (one[first[a]] + two[second[b]], a, b))
    return cells


def _probes(books, d, sizes, wanted):
    def run(batches):
        for batch in batches:
            one, two = _distances(_matrix(batch["vector"], d), books)
            rows, firsts, seconds = [], [], []
            for k, (a, b) in enumerate(zip(one, two)):
                by_first = {}
                for i, j in walk(a, b, sizes, wanted):
                    by_first.setdefault(i, []).append(j)
                rows += [k] * len(by_first)
                firsts += by_first
                seconds += by_first.values()
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(rows), pa.array(firsts, pa.int32()), pa.array(seconds, pa.list_(pa.int32())), batch["vector"].take(rows)],
                ["query_id", "first", "seconds", "vector"])
    return run


def _rerank(d, k):
    def run(entries, queries):
        if not entries.num_rows or not queries.num_rows:
            return pa.table({c: pa.array([], pa.float64() if c == "score" else pa.int64()) for c in ("query_id", "vec_id", "key", "copies", "score")})
        ids, keys = entries["vec_id"].to_numpy(), entries["key"].to_numpy()
        order = np.lexsort((keys, ids))
        copies = entries["copies"].to_numpy()[order]
        ids, keys, e = ids[order], keys[order], _matrix(entries["vector"].combine_chunks(), d)[order]
        second = entries["second"].to_numpy()[order]
        q, owners = _matrix(queries["vector"].combine_chunks(), d), queries["query_id"].to_numpy()
        length = np.sqrt((e * e).sum(axis=1))
        out = []
        for owner, x, cells in zip(owners, q, queries["seconds"].to_pylist()):
            visited = np.zeros(second.max() + 1, bool)
            visited[[c for c in cells if c < visited.size]] = True
            at = np.flatnonzero(visited[second] & (ids != owner))
            # Sums along rows: equal vectors have equal scores wherever they lie.
            score = (e[at] * x).sum(axis=1) / (length[at] * np.sqrt((x * x).sum()))
            best = np.argsort(-score, kind="stable")[:k]
            out.append((np.full(best.size, owner), ids[at[best]], keys[at[best]], copies[at[best]], score[best]))
        found = [np.concatenate(c) for c in zip(*out)]
        return pa.table(dict(zip(("query_id", "vec_id", "key", "copies", "score"), found)))
    return run


def search(vectors, is_query, k=5, id_column="vec_id", vector_column="embedding", share=CANDIDATE_SHARE,
           least=LEAST_CANDIDATES, centroids=CENTROIDS):
    """(query_id, rank, vec_id, score): the k nearest found of every query, nearest first, ties to the smaller id.

    ``is_query`` is a condition on the id column, written with its output name ``vec_id``.
    """
    spark = vectors.sparkSession
    rows, d = usable(vectors, id_column, vector_column)
    if not d:
        return spark.createDataFrame([], RESULT)
    books = fit_codebooks(rows, d, centroids)
    # Equal rows are one, with their count.
    folded = (rows.groupBy("vec_id", "vector").agg(F.count("*").alias("copies"))
              .select("vec_id", F.xxhash64("vector").alias("key"), "copies", "vector"))
    entries = materialize(folded.mapInArrow(_assign(books, d),
                                            "vec_id BIGINT, key BIGINT, copies BIGINT, first INT, second INT, vector ARRAY<DOUBLE>"))
    # At most one row for each pair of centroids.
    cells = entries.groupBy("first", "second").agg(F.sum("copies").alias("n"), F.count("*").alias("rows")).collect()
    sizes = {(r["first"], r["second"]): r["n"] for r in cells}
    wanted = max(least, k + 1, share * sum(sizes.values()))
    probes = materialize(entries.where(is_query).select("vec_id", "vector").mapInArrow(
        _probes(books, d, sizes, wanted), "query_id BIGINT, first INT, seconds ARRAY<INT>, vector ARRAY<DOUBLE>"))
    held = {}
    for r in cells:
        held[r["first"]] = held.get(r["first"], 0) + r["rows"]
    asked = {r["first"]: r["n"] for r in probes.groupBy("first").agg(F.count("*").alias("n")).collect()}
    blocks = spark.createDataFrame([(c, -(-n // BLOCK_ROWS), -(-asked[c] // BLOCK_ROWS)) for c, n in held.items() if c in asked],
                                   "first INT, entry_blocks INT, query_blocks INT")
    blocks = F.broadcast(blocks)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = (entries.join(blocks, "first").withColumn("e", F.pmod(F.xxhash64("vec_id", "key"), "entry_blocks").cast("int"))
             .select("first", "e", each("query_blocks").alias("q"), "vec_id", "key", "copies", "second", "vector"))
    asking = (probes.join(blocks, "first").withColumn("q", F.pmod(F.xxhash64("query_id", "vector"), "query_blocks").cast("int"))
              .select("first", each("entry_blocks").alias("e"), "q", "query_id", "seconds", "vector"))
    near = (dealt.groupBy("first", "e", "q").cogroup(asking.groupBy("first", "e", "q"))
            .applyInArrow(_rerank(d, k), "query_id BIGINT, vec_id BIGINT, key BIGINT, copies BIGINT, score DOUBLE"))
    # An entry found by several vectors of a query counts once.
    hits = near.groupBy("query_id", "vec_id", "key").agg(F.max("score").alias("score"), F.max("copies").alias("copies"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "key")
    hits = hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    each_copy = hits.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    return (each_copy.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("place"))).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


@query("op7_multi_index")
def op7(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0)
