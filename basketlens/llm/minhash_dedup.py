"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

1. Each text becomes a set of 128-bit keys of its five-word shingles (``textbytes.span_keys`` of the words, paired).
   Texts whose sets are equal, known by a 128-bit digest of the set, form a class, and from there on a class, which
   has a number, stands for all its copies, so copies never meet in pairs.
2. Signatures (128 minima, 16 bits kept of each) are cut into bands; classes with an equal band
   share a bucket. Buckets with the same members are kept once.
3. Members of a bucket are compared by their signatures, 16 minima at a time. After each batch a
   pair is dropped when its posterior probability of reaching the wanted similarity is below
   the miss probability (uniform prior, so the posterior is a binomial tail). Large buckets are cut
   into blocks, and every two blocks of a bucket meet in a task of their own.
4. A task names only a spanning forest of the surviving pairs, the most similar first. These are
   confirmed on the full shingle sets and give first components. Then the buckets that still hold
   several components name all their surviving pairs between components, which are confirmed too.
   Where these would be more than ``PAIRS_PER_MEMBER`` for each member, the members' full sets are
   brought to the task instead, compared there, and only confirmed links between components leave it.
   So no link between different components is lost, and the pairs of a group are never listed.

Defined cases: a text that is null, empty or without words has no shingles and no link. A text of
fewer than five words has its whole sequence as its only shingle. Rows repeated or with equal texts
are linked. A null id takes part in its group but never names it; a group with null ids only has a
null component. Columns other than id and text are ignored, whatever their names. An empty table
gives an empty table.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketlens.llm import textbytes
from basketlens.llm.components import components
from basketlens.llm.registry import query, table
from basketlens.operators.skew import attach_by_key
from basketlens.sources.staging import materialize

SIMILARITY = (75, 100)
HASHES = 128
ROWS_PER_BAND = 4
BATCH = 16
MISS_PROBABILITY = 1e-5
BLOCK_MEMBERS = 4096
SET_BLOCK_MEMBERS = 512  # of full sets, which are larger than signatures
PAIRS_PER_MEMBER = 4
PAIRS_AT_ONCE = 1 << 16


def needed_matches(hashes=HASHES, batch=BATCH, similarity=SIMILARITY, miss=MISS_PROBABILITY):
    """For each batch end n: the fewest matches m of n with P(s >= t | m of n) >= miss.

    With a uniform prior the posterior is Beta(m+1, n-m+1), so P(s >= t) = P(Binomial(n+1, t) <= m).
    """
    t = similarity[0] / similarity[1]
    out = []
    for n in range(batch, hashes + 1, batch):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


# ---- sets and signatures ----------------------------------------------------------------

def text_sets(column):
    """For each slice of whole texts: (first row, the two lanes of the shingles' keys, bounds by text)."""
    for low, data, offsets in textbytes.slices(column):
        (hashes, more), bounds = textbytes.shingle_keys(data, offsets)
        yield low, hashes, more, bounds


def distinct_keys(hashes, more):
    """The different keys in ascending order, one row of two numbers each."""
    order = np.argsort(hashes, kind="stable")
    a, b = hashes[order], more[order]
    again = a[1:] == a[:-1]
    if (again & (b[1:] != b[:-1])).any():  # one lane alone is equal: order by both
        order = np.lexsort((more, hashes))
        a, b = hashes[order], more[order]
        again = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    fresh = np.concatenate([np.ones(min(1, a.size), bool), ~again])
    return np.stack([a[fresh], b[fresh]], axis=1)


def class_of(distinct):
    """The digest of a set of keys in ascending order, as two signed 64-bit numbers."""
    return np.frombuffer(hashlib.blake2b(distinct.tobytes(), digest_size=16).digest(), np.int64).tolist()


def shared_keys(one, two):
    """How many keys two sets in ascending order have in common."""
    if one.shape[0] > two.shape[0]:
        one, two = two, one
    at = np.minimum(np.searchsorted(two[:, 0], one[:, 0]), len(two) - 1)
    if (two[1:, 0] == two[:-1, 0]).any():  # keys equal in one lane alone lie next to each other
        pairs = set(map(tuple, two.tolist()))
        return sum(tuple(x) in pairs for x in one.tolist())
    return int((two[at] == one).all(axis=1).sum())


def signatures(hashes, bounds):
    """The low 16 bits of the minima, one row for each text that has shingles."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((starts.size, HASHES), dtype=np.uint16)
    if starts.size:
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        seeds = textbytes.salted(7, 2 * HASHES).astype(np.uint32)
        for k in range(HASHES):
            h = (x ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint32(1))
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            out[:, k] = np.minimum.reduceat(h, starts).astype(np.uint16)
    return out


def _describe(batches):
    for batch in batches:
        for low, hashes, more, bounds in text_sets(batch["text"]):
            n = bounds.size - 1
            sizes, classes = np.zeros(n, np.int64), np.zeros((2, n), np.int64)
            for i in range(n):
                if bounds[i + 1] > bounds[i]:
                    distinct = distinct_keys(hashes[bounds[i]:bounds[i + 1]], more[bounds[i]:bounds[i + 1]])
                    sizes[i], classes[:, i] = len(distinct), class_of(distinct)
            filled = iter(signatures(hashes, bounds))
            sig = [next(filled).tobytes() if s else None for s in sizes]
            yield pa.RecordBatch.from_arrays(
                [batch["id"].slice(low, n), batch["digest"].slice(low, n), pa.array(sizes),
                 *(pa.array(c, mask=sizes == 0) for c in classes), pa.array(sig, pa.binary())],
                ["id", "digest", "n_shingles", "c1", "c2", "signature"])


def _bands(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch["signature"].to_pylist()), np.uint16).reshape(batch.num_rows, HASHES)
        packed = np.ascontiguousarray(sig).view(np.uint64)  # four minima make one band
        salted = textbytes.mix(packed ^ textbytes.salted(11, packed.shape[1])[None, :])
        yield pa.RecordBatch.from_arrays(
            [pa.array(salted.view(np.int64).ravel()), pa.array(np.repeat(batch["class"].to_numpy(), packed.shape[1]))],
            ["band", "class"])


# ---- comparison of the members of a bucket ----------------------------------------------

def _survivors(sig, left, right, needed):
    """(left, right, matches) of the pairs whose posterior stays above the miss probability."""
    matches = np.zeros(left.size, np.int16)
    for k, least in enumerate(needed):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches += (sig[left, part] == sig[right, part]).sum(axis=1, dtype=np.int16)
        alive = matches >= least
        left, right, matches = left[alive], right[alive], matches[alive]
        if not left.size:
            break
    return left, right, matches


def _bucket_pairs(starts, sizes):
    """Positions of the two rows of every pair within a group, a bounded number at once."""
    for size in np.unique(sizes[sizes > 1]):
        heads = starts[sizes == size]
        if size * (size - 1) // 2 <= PAIRS_AT_ONCE:
            i, j = np.triu_indices(size, 1)
            step = max(1, PAIRS_AT_ONCE // i.size)
            for k in range(0, heads.size, step):
                yield (heads[k:k + step, None] + i).ravel(), (heads[k:k + step, None] + j).ravel()
        else:
            for head in heads:
                for i in range(size - 1):
                    j = np.arange(i + 1, size)
                    yield np.full(j.size, head + i), head + j


def _forest(left, right, matches, n):
    """Which pairs a spanning forest takes, the most similar first."""
    parent = list(range(n))
    order = np.argsort(-matches, kind="stable")
    taken = []
    for k, a, b in zip(order.tolist(), left[order].tolist(), right[order].tolist()):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a != b:
            parent[a] = b
            taken.append(k)
    return np.array(taken, dtype=np.int64)


def _compare(forest):
    needed = needed_matches()

    def pairs_of(rows):
        """(a, b, bucket, blocks): a pair, or nulls for a group that has too many."""
        group, node, label, side, sig = rows
        n = node.size
        starts = _group_starts(group)
        found = []
        for left, right in _bucket_pairs(starts, np.diff(np.append(starts, n))):
            # In a task of two different blocks (sides 1 and 2) only pairs across them count.
            use = (label[left] != label[right]) & ((side[left] == 0) | (side[left] != side[right]))
            found.append(_survivors(sig, left[use], right[use], needed))
        if not found:
            return None
        left, right, matches = (np.concatenate(x) for x in zip(*found))
        dense = np.empty(0, np.int64)
        if forest:
            take = _forest(left, right, matches, n)
            left, right = left[take], right[take]
        else:
            of_row = np.searchsorted(starts, np.arange(n), side="right") - 1
            many = np.bincount(of_row[left], minlength=starts.size) > PAIRS_PER_MEMBER * np.diff(np.append(starts, n))
            dense = starts[many]
            sparse = ~many[of_row[left]]
            left, right = left[sparse], right[sparse]
        absent = np.concatenate([np.zeros(left.size, bool), np.ones(dense.size, bool)])
        at = np.concatenate([left, dense])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.minimum(node[left], node[right]), dense]), mask=absent),
             pa.array(np.concatenate([np.maximum(node[left], node[right]), dense]), mask=absent),
             pa.array(group[at, 0]), pa.array(group[at, 1])], ["a", "b", "bucket", "blocks"])

    def run(batches):
        def columns(batch):
            return [_group_keys(batch), batch["class"].to_numpy(), batch["label"].to_numpy(), batch["side"].to_numpy(),
                    np.frombuffer(b"".join(batch["signature"].to_pylist()), np.uint16).reshape(-1, HASHES)]
        for rows in _whole_groups(batches, columns):
            out = pairs_of(rows)
            if out is not None:
                yield out

    return run


def _group_keys(batch):
    return np.stack([batch["bucket"].to_numpy(), batch["blocks"].to_numpy()], axis=1)


def _group_starts(group):
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]).any(axis=1)
    return np.flatnonzero(new)


def _whole_groups(batches, columns):
    """Lists of arrays (the first: group keys) cut between groups; the open group waits for more rows."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = columns(batch)
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        other = np.flatnonzero((rows[0] != rows[0][-1]).any(axis=1))
        cut = int(other[-1]) + 1 if other.size else 0
        held = [x[cut:] for x in rows]
        if cut:
            yield [x[:cut] for x in rows]
    if held is not None:
        yield held


def numbered(keys):
    """A number from 0 for each different key."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    ordered = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.concatenate([[0], np.cumsum((ordered[1:] != ordered[:-1]).any(axis=1))])
    return out


def _link_dense(batches):
    """Confirmed links between components of each group, from the members' full sets: a forest."""
    def columns(batch):
        sets = np.empty(batch.num_rows, dtype=object)
        sets[:] = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in batch["shingles"].to_pylist()]
        return [_group_keys(batch), batch["class"].to_numpy(), batch["label"].to_numpy(), batch["side"].to_numpy(), sets]

    for group, node, label, side, sets in _whole_groups(batches, columns):
        bounds = np.append(_group_starts(group), len(group))
        found = []
        for low, high in zip(bounds[:-1], bounds[1:]):
            sizes = np.array([len(x) for x in sets[low:high]])
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            flat = numbered(np.concatenate(sets[low:high]))
            own, sides = label[low:high].copy(), side[low:high]
            marked = np.zeros(flat.max() + 1, dtype=np.int32)
            for i in range(high - low):
                try_ = (own != own[i]) & ((sides == 0) | (sides != sides[i]))
                try_[:i] = False
                if not try_.any():
                    continue
                mine = flat[offsets[i]:offsets[i + 1]]
                marked[mine] = 1
                shared = np.add.reduceat(marked[flat], offsets[:-1])
                marked[mine] = 0
                near = try_ & (SIMILARITY[1] * shared >= SIMILARITY[0] * (sizes + sizes[i] - shared))
                for j in np.flatnonzero(near):
                    if own[j] != own[i]:
                        found.append((min(node[low + i], node[low + j]), max(node[low + i], node[low + j])))
                        own[own == own[j]] = own[i]
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())],
                                         ["a", "b"])


def _labelled(members, labels):
    """Members with the label of their component; only buckets that hold several."""
    if labels is None:
        return members.withColumn("label", F.col("class"))
    labelled = (members.join(labels.select(F.col("node").alias("class"), "root"), "class", "left")
                .withColumn("label", F.coalesce("root", "class")).drop("root"))
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return labelled.join(mixed.where("low <> high").select("bucket"), "bucket", "left_semi")


def _dealt(members, block_members, payload):
    """(bucket, blocks, class, label, side, payload): each member in every task of its bucket that it belongs to.

    The payload is joined before, so a join makes one row for each member of a bucket, however many tasks the member goes to.
    A bucket of one block is a task's group as it is.
    """
    blocks = F.ceil(F.col("size") / block_members).cast("int")
    own = F.pmod(F.col("class"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    # A block's members join the tasks of its pairs once; the block with itself is side 0.
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    pair = F.least("own", "other").cast("long") * F.col("blocks") + F.greatest("own", "other")
    return (members.withColumn("blocks", blocks).withColumn("own", own).select("*", other)
            .select("bucket", pair.alias("blocks"), "class", "label", side.alias("side"), payload))


def _candidates(labelled, signed, forest):
    """Surviving pairs (a, b) of members with different labels, and null pairs for dense groups."""
    rows = (_dealt(labelled.join(signed, "class"), BLOCK_MEMBERS, "signature")
            .repartition("bucket", "blocks").sortWithinPartitions("bucket", "blocks"))
    return rows.mapInArrow(_compare(forest), "a BIGINT, b BIGINT, bucket BIGINT, blocks BIGINT")


# ---- exact confirmation -----------------------------------------------------------------

def _sets(batches):
    """The sets of texts, where they are those of the class that is named with the text."""
    for batch in batches:
        found = []
        for low, hashes, more, bounds in text_sets(batch["text"]):
            named = batch.slice(low, bounds.size - 1).select(["class", "c1", "c2"]).to_pylist()
            for i, row in enumerate(named):
                distinct = distinct_keys(hashes[bounds[i]:bounds[i + 1]], more[bounds[i]:bounds[i + 1]])
                if class_of(distinct) == [row["c1"], row["c2"]]:
                    found.append((row["class"], distinct.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())], ["class", "shingles"])


def _confirm(batches):
    for batch in batches:
        keep = []
        for one, two in zip(batch["one"], batch["two"]):
            one, two = (np.frombuffer(x.as_buffer(), np.uint64).reshape(-1, 2) for x in (one, two))
            shared = shared_keys(one, two)
            keep.append(SIMILARITY[1] * shared >= SIMILARITY[0] * (len(one) + len(two) - shared))
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _held(texts, classes, members):
    """(class, c1, c2, text): one text of each class that shares a bucket with another, moved once for all that follows."""
    named = materialize(classes.join(members.select("class").distinct(), "class", "left_semi").select("class", "c1", "c2", "known.*"))
    same = texts["id"].eqNullSafe(named["known_id"]) & (texts["digest"] == named["known_digest"])
    # The same join at every size: the texts are shuffled once, the named rows grow with them.
    return materialize(texts.join(named.hint("merge"), same).select("class", "c1", "c2", "text"))


def _shingle_sets(held, wanted):
    """(class, shingles) of the wanted classes, one row each."""
    sets = held.join(wanted, "class", "left_semi").mapInArrow(_sets, "class BIGINT, shingles BINARY")
    return materialize(sets.groupBy("class").agg(F.first("shingles").alias("shingles")))


def _confirmed(pairs, sets):
    """The pairs whose full shingle sets are similar enough."""
    joined = (pairs.join(sets.select(F.col("class").alias("a"), F.col("shingles").alias("one")), "a")
              .join(sets.select(F.col("class").alias("b"), F.col("shingles").alias("two")), "b")
              .select("a", "b", "one", "two"))
    return joined.mapInArrow(_confirm, "a BIGINT, b BIGINT")


def _ends(pairs):
    return pairs.select(F.explode(F.array("a", "b")).alias("class"))


def near_duplicates(docs, id_column="doc_id", text_column="text"):
    """(id, n_shingles, component_id, kept, digest, class, component): see the module's description.

    ``digest`` is xxhash64 of the raw text, ``class`` a number of its shingle set and ``component`` of its
    component (null without shingles); they tell texts apart where ids are null or repeated.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text_column).alias("digest"),
                        F.col(text_column).alias("text"))
    described = materialize(texts.mapInArrow(
        _describe, "id BIGINT, digest BIGINT, n_shingles BIGINT, c1 BIGINT, c2 BIGINT, signature BINARY"))
    known = F.struct(F.col("id").alias("known_id"), F.col("digest").alias("known_digest"))
    filled = described.where("c1 is not null").groupBy("c1", "c2").agg(
        F.first("signature").alias("signature"), F.min("id").alias("least"), F.count("*").alias("copies"), F.min(known).alias("known"))
    classes = materialize(filled.withColumn("class", F.monotonically_increasing_id()))
    signed = classes.select("class", "signature")
    bands = signed.mapInArrow(_bands, "band BIGINT, class BIGINT")
    stats = (bands.groupBy("band").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("class")).alias("x"),
                                       F.bit_xor(F.xxhash64(F.lit(1), "class")).alias("y")).where("size > 1"))
    buckets = stats.groupBy("size", "x", "y").agg(F.min("band").alias("band"))
    members = materialize(bands.join(buckets.select("band", "size"), "band")
                          .select(F.col("band").alias("bucket"), "size", "class").distinct())
    held = _held(texts, classes, members)
    tried = materialize(_candidates(_labelled(members, None), signed, forest=True).select("a", "b").distinct())
    links = materialize(_confirmed(tried, _shingle_sets(held, _ends(tried).distinct())))
    mixed = materialize(_labelled(members, components(links)))
    rest = materialize(_candidates(mixed, signed, forest=False))
    pairs = materialize(rest.where("a is not null").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
    dense = mixed.join(rest.where("a is null").select("bucket").distinct(), "bucket", "left_semi")
    sets = _shingle_sets(held, _ends(pairs).union(dense.select("class")).distinct())
    linked = (_dealt(dense.join(sets, "class"), SET_BLOCK_MEMBERS, "shingles")
              .repartition("bucket", "blocks").sortWithinPartitions("bucket", "blocks")
              .mapInArrow(_link_dense, "a BIGINT, b BIGINT"))
    labels = components(links.union(_confirmed(pairs, sets)).union(linked))
    # Names of the components: the smallest id of all rows of all their classes.
    named = (classes.select("class", "c1", "c2", "least", "copies").join(labels.withColumnRenamed("node", "class"), "class", "left")
             .withColumn("root", F.coalesce("root", "class")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = named.drop("least").join(least, "root").select("c1", "c2", "copies", "class", "root", "component_id")
    found = attach_by_key(described.drop("signature"), by_class, ["c1", "c2"], "copies")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(id_column), "n_shingles", component.alias("component_id"),
                        F.col("id").eqNullSafe(component).alias("kept"), "digest", "class", F.col("root").alias("component"))


@query("op4_minhash_dedup")
def op4(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
