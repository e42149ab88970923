"""Words in windows that repeat from an earlier document, found by level-wise doubling.

Levels are window lengths in words: half the wanted length, that length, its double, and so on. Only windows that
repeat at one level are extended to the next, until none is left:

- Equal texts are one, under their smallest id: a later copy loses every word if it has a window at all. So a group
  of copies of any size is one text from here on, written once, in buckets by its digest.
- At the first level the representative of each wanted window is its half-length window with the least key. Equal
  windows have equal representatives, so no repetition is missed, while few of the half-length windows are shuffled.
- Where a representative occurs in two documents, the wanted windows around it are extended to full length and counted.
- Beyond, a window that repeats and is followed by one that repeats makes a candidate of twice the length; its key is
  made from their keys, the texts are not needed.

Windows are told apart by 128-bit keys (``textbytes.span_keys``, ``paired``). Counts combine before a shuffle, and a
window that very many documents share is attached to them without sending it to one task (``attach_by_key``).

Defined cases: a null text has no words. Rows with equal ids don't remove each other's words. A row with a null id loses
nothing and removes nothing. A text of fewer words than a window keeps them all. Other columns are ignored. An empty table gives
no rows. A text is held whole by its task, as is the list of its places that repeat.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketlens.llm import textbytes
from basketlens.llm.registry import query, table
from basketlens.operators.skew import attach_by_key
from basketlens.sources.staging import materialize, materialize_bucketed

WINDOW = 50
KEY = ["k1", "k2"]
NO_WORDS = hashlib.sha256(b"").hexdigest()
FACTS = "k1 BIGINT, k2 BIGINT, first BIGINT, copies BIGINT, n_words BIGINT, sha256 STRING, marks ARRAY<STRUCT<h: BIGINT, place: INT>>"
CANDIDATES = "row BIGINT, first BIGINT, windows ARRAY<STRUCT<place: INT, a: BIGINT, b: BIGINT>>"


def with_key(docs, id_column, text_column):
    """(doc_id, text, k1, k2): 120 bits of the text's digest."""
    digest = F.sha2("text", 256)
    part = (lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long"))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.select("doc_id", "text", part(1).alias("k1"), part(16).alias("k2"))


# ---- kernels over a slice of texts ----------------------------------------------------------

class Windows:
    """Places and keys of the windows of a slice of texts; a place counts the words of the slice."""

    def __init__(self, data, offsets, length):
        self.starts, self.ends, self.first = textbytes.words(data, offsets)
        self.half = (length + 1) // 2
        self.halves = textbytes.runs_of(textbytes.span_keys(data, self.starts, self.ends), self.half)
        sizes = np.maximum(np.diff(self.first) - length + 1, 0)
        self.sizes = sizes
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        #: the places where a window starts, and the place of its representative
        self.places = np.arange(bounds[-1]) + np.repeat(self.first[:-1] - bounds[:-1], sizes)
        self.owner = np.repeat(np.arange(sizes.size), sizes)
        reach = length - self.half
        if self.places.size:
            views = np.lib.stride_tricks.sliding_window_view(self.halves[0], reach + 1)
            self.marks = self.places + views[self.places[0]:self.places[-1] + 1].argmin(axis=1)[self.places - self.places[0]]
        else:
            self.marks = self.places
        self.reach = reach

    def keys(self, places):
        return textbytes.paired([x[places] for x in self.halves], [x[places + self.reach] for x in self.halves])


def _lists(counts, fields):
    bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    names, values = zip(*fields.items())
    return pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays([pa.array(v) for v in values], names))


def _signed(x):
    return np.ascontiguousarray(x).view(np.int64)


def _facts(length):
    def run(batches):
        for batch in batches:
            for low, data, offsets in textbytes.slices(batch["text"]):
                n = offsets.size - 1
                found = Windows(data, offsets, length)
                fresh = np.ones(found.marks.size, bool)
                fresh[1:] = found.marks[1:] != found.marks[:-1]
                marks, owner = found.marks[fresh], found.owner[fresh]
                raw, bounds = data.tobytes(), offsets.tolist()
                digests = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(bounds, bounds[1:])]
                lists = _lists(np.bincount(owner, minlength=n), {
                    "h": _signed(found.halves[0][marks]), "place": (marks - found.first[owner]).astype(np.int32)})
                some = batch.slice(low, n)
                yield pa.RecordBatch.from_arrays(
                    [some["k1"], some["k2"], some["first"], some["copies"], pa.array(np.diff(found.first)), pa.array(digests), lists],
                    ["k1", "k2", "first", "copies", "n_words", "sha256", "marks"])
    return run


def _extend(length):
    """Windows of full length whose representative is among ``places``."""
    def run(batches):
        for batch in batches:
            for low, data, offsets in textbytes.slices(batch["text"]):
                n = offsets.size - 1
                some = batch.slice(low, n)
                found = Windows(data, offsets, length)
                listed = some["places"]
                alive = np.zeros(found.starts.size + 1, bool)
                sizes = np.diff(listed.offsets.to_numpy())
                alive[np.repeat(found.first[:-1], sizes) + listed.flatten().to_numpy()] = True
                chosen = alive[found.marks]
                places, owner = found.places[chosen], found.owner[chosen]
                a, b = found.keys(places)
                lists = _lists(np.bincount(owner, minlength=n), {
                    "place": (places - found.first[owner]).astype(np.int32), "a": _signed(a), "b": _signed(b)})
                yield pa.RecordBatch.from_arrays([some["row"], some["first"], lists], ["row", "first", "windows"])
    return run


def _double(length):
    """From the windows of a level that repeat, in one list for each text, the candidates of twice the length."""
    def run(batches):
        for batch in filter(len, batches):
            counts, places, keys = [], [], ([], [])
            for at in range(len(batch)):
                found = batch["windows"][at].values
                place, a, b = (found.field(c).to_numpy() for c in ("place", "a", "b"))
                order = np.argsort(place)
                place, lanes = place[order], [x[order].view(np.uint64) for x in (a, b)]
                follows = np.searchsorted(place, place + length)
                have = np.flatnonzero(place[np.minimum(follows, place.size - 1)] == place + length)
                for out, x in zip(keys, textbytes.paired([x[have] for x in lanes], [x[follows[have]] for x in lanes])):
                    out.append(x)
                counts.append(have.size)
                places.append(place[have])
            lists = _lists(counts, {"place": np.concatenate(places).astype(np.int32), "a": _signed(np.concatenate(keys[0])),
                                    "b": _signed(np.concatenate(keys[1]))})
            yield pa.RecordBatch.from_arrays([batch["row"], batch["first"], lists], ["row", "first", "windows"])
    return run


def _cut(length):
    """Number and digest of the words that no window at ``places`` covers."""
    def run(batches):
        for batch in filter(len, batches):
            rows = []
            for row, text, places in zip(batch["row"].to_pylist(), batch["text"], batch["places"]):
                words = text.as_buffer().to_pybytes().split()
                places = places.values.to_numpy()
                edges = np.bincount(places, minlength=len(words) + 1) - np.bincount(places + length, minlength=len(words) + 1)
                kept = [w for w, covered in zip(words, np.cumsum(edges).tolist()) if not covered]
                rows.append((row, len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["row", "n_removed", "kept_sha256"])
    return run


# ---- levels ---------------------------------------------------------------------------------

def _repeating(windows, key):
    """(key, row, place, least) of the windows that occur in texts with different ids; ``least`` is the smallest of these.

    The table of repeated windows grows with the data, so it is never broadcast; the windows that most texts share are.
    """
    found = windows.groupBy(*key).agg(F.min("first").alias("least"), F.max("first").alias("most"), F.count("*").alias("n"))
    rows = windows.select(*key, "row", "place")
    return attach_by_key(rows, found.where("least < most").drop("most"), key, "n", broadcast_bytes=0).where("n IS NOT NULL").drop("n")


def repeated(texts, facts, length):
    """(row, places of removed windows) and (row, longest repeated length) of ``texts`` under their smallest id."""
    rows = facts.where("first IS NOT NULL")
    marks = rows.select("row", "first", F.explode("marks").alias("m")).select("row", "first", "m.*")
    near = _repeating(marks, ["h"]).groupBy("row").agg(F.collect_list("place").alias("places"))
    near = rows.select("row", "first", *KEY).join(near, "row")
    joined = texts.select(*KEY, "text").join(near.hint("shuffle_hash"), KEY)
    candidates = materialize(joined.mapInArrow(_extend(length), CANDIDATES))
    levels, level = [], length
    while True:
        windows = candidates.select("row", "first", F.explode("windows").alias("w")).select("row", "first", "w.*")
        lists = _repeating(windows, ["a", "b"]).groupBy("row").agg(F.collect_list(F.struct("place", "a", "b", "least")).alias("windows"))
        # A text's repeated windows in one list; ``later`` are the places that repeat from a smaller id.
        later = F.filter("windows", lambda w: w["least"] < F.col("first"))["place"].alias("later")
        kept = materialize(lists.join(rows.select("row", "first"), "row").select("row", "first", "windows", later))
        levels.append(kept.where(F.size("later") > 0).select("row", "later", F.lit(level).cast("long").alias("longest")))
        if kept.isEmpty():
            break
        candidates = materialize(kept.mapInArrow(_double(level), CANDIDATES).where(F.size("windows") > 0))
        level *= 2
    longest = levels[0].select("row", "longest")
    for more in levels[1:]:
        longest = longest.union(more.select("row", "longest"))
    return levels[0].select("row", F.col("later").alias("places")), longest.groupBy("row").agg(F.max("longest").alias("longest"))


def without_repeats(docs, length=WINDOW, id_column="doc_id", text_column="text"):
    """(id, n_words, n_removed, kept_sha256, longest) of every row.

    ``longest`` is the greatest of the lengths ``length``, twice, four times ... at which a window of the row's text
    repeats from a document with a smaller id; 0 if there is none.
    """
    if length < 2:
        raise ValueError("a window has two words at least")
    keyed = with_key(docs, id_column, text_column)
    texts = materialize_bucketed(keyed.groupBy(*KEY).agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"),
                                                         F.any_value("text").alias("text")), KEY)
    facts = materialize(texts.mapInArrow(_facts(length), FACTS).withColumn("row", F.monotonically_increasing_id()))
    removed, longest = repeated(texts, facts, length)
    removed = facts.select("row", *KEY).join(removed, "row")
    cut = texts.select(*KEY, "text").join(removed.hint("shuffle_hash"), KEY).mapInArrow(
        _cut(length), "row BIGINT, n_removed BIGINT, kept_sha256 STRING")
    judged = (facts.select("row", *KEY, "first", "copies", "n_words", "sha256").join(cut, "row", "left").join(longest, "row", "left"))
    rows = attach_by_key(keyed.select("doc_id", *KEY), judged.drop("row"), KEY, "copies", broadcast_bytes=0)
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= length)
    known = F.col("doc_id").isNotNull()
    whole = F.lit(length).cast("long") * F.pow(F.lit(2.0), F.floor(F.log2(F.col("n_words") / length))).cast("long")
    return rows.select(
        F.col("doc_id").alias(id_column), "n_words",
        F.when(copy, F.col("n_words")).when(known, F.coalesce("n_removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, NO_WORDS).when(known, F.coalesce("kept_sha256", "sha256")).otherwise(F.col("sha256")).alias("kept_sha256"),
        F.when(copy, whole).when(known, F.coalesce("longest", F.lit(0))).otherwise(0).cast("long").alias("longest"))


def _level_sql(length):
    """Windows of one length that repeat, from the pairs of half as long ones that do."""
    half = length // 2
    return f"""l{length} AS (SELECT doc_id, i, g, least FROM (
  SELECT doc_id, i, g, min(doc_id) OVER (PARTITION BY g) AS least, max(doc_id) OVER (PARTITION BY g) AS most FROM (
    SELECT x.doc_id, x.i, dense_rank() OVER (ORDER BY x.g, y.g) AS g
    FROM l{half} x JOIN l{half} y ON x.doc_id = y.doc_id AND y.i = x.i + {half})) WHERE least < most)"""


# Windows as texts; longer ones by the numbers of their halves, to the greatest length in the given tables.
LEVELS = [WINDOW << k for k in range(9)]
OP11_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
l{WINDOW} AS (SELECT doc_id, i, g, least FROM (
  SELECT doc_id, i, dense_rank() OVER (ORDER BY s) AS g, min(doc_id) OVER (PARTITION BY s) AS least,
    max(doc_id) OVER (PARTITION BY s) AS most FROM p) WHERE least < most),
{", ".join(map(_level_sql, LEVELS[1:]))},
r AS (SELECT doc_id, max(size) AS longest FROM ({" UNION ALL ".join(
    f"SELECT DISTINCT doc_id, {n} AS size FROM l{n} WHERE least < doc_id" for n in LEVELS)}) GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS k FROM l{WINDOW} WHERE least < doc_id),
c AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id),
a AS (SELECT doc_id, w, coalesce(longest, 0) AS longest, len(coalesce(ks, [])) AS n_removed,
    CASE WHEN ks IS NULL THEN w ELSE [w[j] FOR j IN range(1, len(w) + 1) IF NOT list_contains(ks, j)] END AS kept
  FROM d LEFT JOIN c USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256, CAST(longest AS BIGINT) AS longest FROM a
"""


@query("op11_repeated_windows", OP11_SQL)
def op11(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents"))
