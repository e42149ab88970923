"""Similarity digests from improbable byte windows.

A window of ``WINDOW`` bytes is the rarer the higher its self-information: the sum, over its bytes, of minus the log
of a byte's probability after the byte before. These probabilities are counted over all texts. A window
is selected when its information is the highest within ``REACH`` windows to either side (a hash of the window breaks
ties), so selection depends on nearby bytes only and survives edits elsewhere. Selected windows go in order into Bloom
filters of ``FILTER_BITS`` bits, ``HASHES`` bits each; a full filter (``FILTER_FEATURES`` windows) starts the next of the chain.

Likeness of two digests: each filter of the shorter chain takes its best normalised overlap with the filters of the other
(shared bits above those expected by chance, over the most possible), weighted by its number of windows.
Equal digests have likeness 1, and so have two empty ones; an empty one and another have 0.

A digest is written as text: for each filter the number of windows and the filter's bytes, in hexadecimal. Of a text
of fewer than ``SHORT_TEXT`` bytes all windows of ``SHORT_WINDOW`` bytes (or the text) are taken; the empty text has the empty digest.

Documents are ordered by descending id (null ids last, then by text), sorted over the cluster. A task walks its
sorted part; only the pair across two parts' border is joined afterwards, with one row for each part.
Defined cases: a null text is empty. Repeated rows are neighbours. One document alone is its own next. Other columns
are ignored. An empty table gives an empty table.
"""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window, functions as F

from basketlens.llm import textbytes
from basketlens.llm.registry import query, table
from basketlens.sources.staging import remember, shared_folder

WINDOW = 16
REACH = 10
SHORT_TEXT, SHORT_WINDOW = 64, 4
FILTER_BITS = 2048
FILTER_FEATURES = 128
HASHES = 3
SCALE = 256  # steps of a byte's information per nat


# ---- how improbable a byte is -----------------------------------------------------------

def _pair_counts(batches):
    """Counts of byte pairs, one row for each pair in the task."""
    counts = np.zeros(65536, np.int64)
    for batch in batches:
        for _, data, offsets in textbytes.slices(batch["text"]):
            if data.size < 2:
                continue
            pairs = data[:-1].astype(np.uint16) * np.uint16(256) + data[1:]
            within = np.ones(pairs.size, bool)
            edges = offsets[1:-1]
            within[edges[(edges > 0) & (edges < data.size)] - 1] = False
            counts += np.bincount(pairs[within], minlength=65536)
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], ["pair", "n"])


def byte_information(docs, text_column="text"):
    """An array of 65536 integers: information of the second byte of each pair, after the first."""
    counted = (docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text")).mapInArrow(_pair_counts, "pair INT, n BIGINT")
               .groupBy("pair").agg(F.sum("n").alias("n")).toPandas())  # as many rows as there are byte pairs
    counts = np.full(65536, 0.5)
    counts[counted["pair"].to_numpy(dtype=np.int64)] += counted["n"].to_numpy(dtype=float)
    by_first = counts.reshape(256, 256)
    return np.round(-np.log(by_first / by_first.sum(axis=1, keepdims=True)) * SCALE).astype(np.int32).ravel()


# ---- digests ----------------------------------------------------------------------------

def _highest(x, reach):
    """The highest value within ``reach`` places to either side, by doubling spans."""
    n, width = x.size, 2 * reach + 1
    padded = np.concatenate([np.zeros(reach, x.dtype), x, np.zeros(reach, x.dtype)])
    span = 1
    while 2 * span <= width:
        padded = np.maximum(padded[:-span], padded[span:])
        span *= 2
    rest = width - span
    return np.maximum(padded[:n], padded[rest:rest + n]) if rest else padded[:n]


def features(data, information):
    """64-bit hashes of the selected windows of one text's bytes, in order."""
    n = data.size
    if n == 0:
        return np.empty(0, np.uint64)
    sums = textbytes.prefix_hash(data)
    if n < SHORT_TEXT:
        starts = np.arange(max(1, n - SHORT_WINDOW + 1))
        return textbytes.span_hash(sums, starts, np.minimum(starts + SHORT_WINDOW, n))
    own = information[data[:-1].astype(np.uint16) * np.uint16(256) + data[1:]]
    total = np.concatenate([[0], np.cumsum(own)])
    # A window's first byte has no byte before it inside the window.
    high = (total[WINDOW - 1:] - total[:n - WINDOW + 1]).astype(np.uint64)
    tie = data[:n - WINDOW + 1].astype(np.uint64) * np.uint64(0x9E37) + data[WINDOW - 1:].astype(np.uint64) * np.uint64(0x85EB)
    rank = (high << np.uint64(16)) | (tie & np.uint64(0xFFFF))
    chosen = np.flatnonzero(rank == _highest(rank, REACH))
    hashes = textbytes.span_hash(sums, chosen, chosen + WINDOW)
    # Equal windows next to each other (a repeated byte) are one feature.
    fresh = np.ones(hashes.size, bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    return hashes[fresh]


def digest(hashes):
    """(windows in each filter, filters as rows of bytes)."""
    filters = -(-hashes.size // FILTER_FEATURES)
    bits = np.zeros((filters, FILTER_BITS), np.uint8)
    at = np.arange(hashes.size) // FILTER_FEATURES
    for k in range(HASHES):
        bits[at, ((hashes >> np.uint64(11 * k)) % np.uint64(FILTER_BITS)).astype(np.int64)] = 1
    return np.bincount(at, minlength=filters), np.packbits(bits, axis=1)


def write_digest(found):
    return ",".join(f"{n}:{row.tobytes().hex()}" for n, row in zip(*found))


def read_digest(text):
    parts = [p.split(":") for p in text.split(",")] if text else []
    rows = [np.frombuffer(bytes.fromhex(p[1]), np.uint8) for p in parts]
    return np.array([int(p[0]) for p in parts], np.int64), np.array(rows).reshape(len(rows), FILTER_BITS // 8)


def likeness(one, two):
    """Between 0 and 1; symmetric in chains of equal length up to which is taken first."""
    if one[0].size == two[0].size and (one[0] == two[0]).all() and (one[1] == two[1]).all():
        return 1.0
    if not one[0].size or not two[0].size:
        return 0.0
    if one[0].size > two[0].size:
        one, two = two, one
    ones, twos = np.bitwise_count(one[1]).sum(axis=1).astype(float), np.bitwise_count(two[1]).sum(axis=1).astype(float)
    best = np.empty(one[0].size)
    for k, row in enumerate(one[1]):
        shared = np.bitwise_count(two[1] & row).sum(axis=1).astype(float)
        chance, most = ones[k] * twos / FILTER_BITS, np.minimum(ones[k], twos)
        best[k] = np.max(np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0))
    return float((best * one[0]).sum() / one[0].sum())


def fingerprint(text, information):
    """A digest of one text."""
    return digest(features(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), information))


# ---- documents and their edited texts ---------------------------------------------------

RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
ROWS = ("doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING, "
        "near_edited DOUBLE, near_next DOUBLE, part INT, edge STRING, text STRING")


def edited(text, after):
    """The text with its last third replaced by as much of the start of the next."""
    cut = len(text) // 3
    return text[:len(text) - cut] + after[:cut] if cut else text


def _compare(doc_id, text, own, after, after_digest, information):
    changed = edited(text, after)
    other = own if changed == text else fingerprint(changed, information)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), write_digest(own),
            write_digest(other), likeness(own, other), likeness(own, after_digest))


def _neighbours(information):
    """Finished rows, and each part's first and last row to be joined with those of the parts around it."""
    def run(batches):
        part, before, rows = TaskContext.get().partitionId(), None, []

        def packed():
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
            names = [*RESULT, "part", "edge", "text"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                own = fingerprint(text, information.value)
                if before is None:
                    rows.append((doc_id, None, None, write_digest(own), None, None, None, part, "first", text))
                else:
                    rows.append((*_compare(*before, text, own, information.value), part, None, None))
                before = (doc_id, text, own)
                if len(rows) >= 1000:
                    yield packed()
                    rows = []
        if before is not None:
            rows.append((before[0], None, None, write_digest(before[2]), None, None, None, part, "last", before[1]))
            yield packed()
    return run


def _borders(information):
    def run(batches):
        for batch in batches:
            rows = [_compare(i, t, read_digest(f), after, read_digest(g), information.value) for i, t, f, after, g in
                    zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "fingerprint", "after", "after_fingerprint")))]
            yield pa.RecordBatch.from_pylist([dict(zip(RESULT, r)) for r in rows], pa.schema(
                [("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in RESULT[2:5]],
                 *[(c, pa.float64()) for c in RESULT[5:]]]))
    return run


def compare_with_next(docs, id_column="doc_id", text_column="text"):
    """One row per document: digests of its text and of its edited text, and likeness to that and to the next document's."""
    spark = docs.sparkSession
    information = spark.sparkContext.broadcast(byte_information(docs, text_column))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
                        F.monotonically_increasing_id().alias("place"))
    # Equal ids go by a hash of their text, equal rows by their place: many of them still spread over tasks.
    ordered = (texts.withColumn("tie", F.xxhash64("text")).orderBy(F.desc_nulls_last("doc_id"), "tie", "place")
               .select("doc_id", "text"))
    # Hexadecimal digests shrink to half under a stronger codec.
    path = remember(spark, f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}")
    ordered.mapInArrow(_neighbours(information), ROWS).write.option("compression", "zstd").parquet(path)
    walked = spark.read.schema(ROWS).parquet(path)
    # One row for each sorted part; the part after the last is the first.
    firsts = walked.where("edge = 'first'").select("part", F.col("text").alias("after"), F.col("fingerprint").alias("after_fingerprint"))
    parts = firsts.select("part")
    order = Window.orderBy("part")
    start = F.min("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = parts.select("part", F.coalesce(F.lead("part").over(order), start).alias("following"))
    lasts = walked.where("edge = 'last'").select("part", "doc_id", "text", "fingerprint")
    borders = (lasts.join(following, "part").join(firsts.withColumnRenamed("part", "following"), "following")
               .select("doc_id", "text", "fingerprint", "after", "after_fingerprint")
               .mapInArrow(_borders(information), ", ".join(ROWS.split(", ")[:7])))
    return walked.where("edge is null").select(*RESULT).union(borders).withColumnRenamed("doc_id", id_column)


@query("op10_bloom_digest")
def op10(spark, sf_dir):
    return compare_with_next(table(spark, sf_dir, "documents"))
