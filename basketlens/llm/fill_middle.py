"""Fill-in-the-middle texts: a document is cut at two unit boundaries and its parts are put in another order.

A unit is a run of ASCII letters or any other single code point. The cut places are numbers of units, drawn from a
digest of the document's id, so a document's result depends on nothing but itself. To find them, a text is divided
into blocks of ``BLOCK`` bytes; two Fenwick trees over the blocks hold the units that start in a block and its code
points. A descent by halving steps through both trees at once gives the block of a cut with the units and code points
before it, and only that block is searched for the boundary. A text is never made into a list of units.

The output joins the parts with three markers. A marker's first character occurs in no other place of any marker, and
a text that holds a marker is left plain, so the output has each marker once and ``restore`` finds the parts again.

Defined cases: a null text is empty; an empty text is plain with 0 units. A null id draws from the seed alone. Rows
with equal ids are cut by the same draws, each on its own text. Other columns are ignored, so no name can clash. An empty
table gives no rows. A text of any length is one row and is held whole by its task.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketlens.llm import textbytes
from basketlens.llm.registry import query, table

BLOCK = 512
MARKERS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100
SEED = "1"
SCHEMA = "id BIGINT, n BIGINT, form STRING, prefix_chars BIGINT, middle_chars BIGINT, output STRING"

LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True


def unit_starts(data, offsets):
    """Where a unit starts: at the first byte of every code point, except at a letter after a letter."""
    letter = LETTER[data]
    starts = (data & 0xC0) != 0x80
    inner = letter[1:] & letter[:-1]
    edges = offsets[(offsets > 0) & (offsets < data.size)]
    inner[edges - 1] = False
    starts[1:] &= ~inner
    return starts


def fenwick(counts):
    """The tree of a list of counts: entry i holds the sum of the lowest-bit(i) counts that end at i (from 1)."""
    sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    at = np.arange(sums.size)
    return (sums - sums[at - (at & -at)]).tolist()


class Blocks:
    """Units and code points of one text by block."""

    def __init__(self, starts, leads):
        self.starts, self.leads = starts, leads
        edges = np.arange(0, starts.size, BLOCK)
        self.units = fenwick(np.add.reduceat(starts, edges, dtype=np.int64))
        self.chars = fenwick(np.add.reduceat(leads, edges, dtype=np.int64))

    def place(self, unit):
        """(byte, code points before it) of the start of a unit, counted from 0; the text's end beyond the last."""
        block = units = chars = 0
        step = 1 << (len(self.units).bit_length() - 1)
        while step:
            after = block + step
            if after < len(self.units) and units + self.units[after] <= unit:
                block, units, chars = after, units + self.units[after], chars + self.chars[after]
            step >>= 1
        low = block * BLOCK
        if low >= self.starts.size:
            return self.starts.size, chars
        at = int(np.flatnonzero(self.starts[low:low + BLOCK])[unit - units])
        return low + at, chars + int(np.count_nonzero(self.leads[low:low + at]))


def draws(seed, doc_id):
    """Four numbers of 32 bits from the digest of ``seed:id``."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]


def check_markers(markers):
    heads = [m[:1] for m in markers]
    if len(set(markers)) != 3 or not all(heads) or any(h in m[1:] for h in heads for m in markers):
        raise ValueError("three different markers are needed whose first characters occur nowhere else in them")


def _arrange(markers, plain_from, spm_below, seed):
    marks = [m.encode() for m in markers]
    prefix_mark, suffix_mark, middle_mark = marks

    def rows(ids, data, offsets):
        """One (n, form, prefix code points, middle code points, output bytes) for each text of a slice."""
        starts, leads, raw = unit_starts(data, offsets), (data & 0xC0) != 0x80, data.tobytes()
        for doc_id, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist()):
            text = raw[a:b]
            n = int(np.count_nonzero(starts[a:b]))
            h1, h2, h3, h4 = draws(seed, doc_id)
            if not text or h3 % 100 >= plain_from or any(m in text for m in marks):
                yield n, "plain", None, None, text
                continue
            first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
            blocks = Blocks(starts[a:b], leads[a:b])
            (i, before), (j, until) = blocks.place(first), blocks.place(second)
            prefix, middle, suffix = text[:i], text[i:j], text[j:]
            if h4 % 100 < spm_below:
                form, parts = "spm", (suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle)
            else:
                form, parts = "psm", (prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle)
            yield n, form, before, until - before, b"".join(parts)

    def run(batches):
        for batch in batches:
            for low, data, offsets in textbytes.slices(batch["text"]):
                ids = batch["id"].slice(low, offsets.size - 1)
                n, form, prefix, middle, output = zip(*rows(ids.to_pylist(), data, offsets))
                bounds = np.concatenate([[0], np.cumsum([len(o) for o in output])])
                if bounds[-1] < 1 << 31:
                    texts = pa.StringArray.from_buffers(len(output), pa.py_buffer(bounds.astype(np.int32).tobytes()),
                                                        pa.py_buffer(b"".join(output)))
                else:
                    texts = pa.array([o.decode() for o in output], pa.large_string())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), texts], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(docs, id_column="doc_id", text_column="text", markers=MARKERS, plain_from=PLAIN_FROM, spm_below=SPM_BELOW,
              seed=SEED):
    """(id, n, form, prefix_chars, middle_chars, output) of every row; the counts are null where the form is plain."""
    check_markers(markers)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found = texts.mapInArrow(_arrange(markers, plain_from, spm_below, seed), SCHEMA)
    return found.withColumnRenamed("id", id_column)


def restore(output, form, markers=MARKERS):
    """The text that an output of the given form was made from."""
    check_markers(markers)
    parts = F.array(F.split(output, "|".join(re.escape(m) for m in markers), -1))
    psm = F.transform(parts, lambda p: F.concat(p[1], p[3], p[2]))[0]
    spm = F.transform(parts, lambda p: F.concat(p[2], p[3], p[1]))[0]
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


# The units of a text as a list, cut by number; h1 to h4 as the operator draws them.
OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
r AS (SELECT doc_id, text, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1,
    ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2, ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3,
    ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4 FROM d),
c AS (SELECT doc_id, text, n, array_to_string(u[1:least(c1, c2)], '') AS p,
    array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(u[greatest(c1, c2) + 1:], '') AS s,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
         WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM c
"""


@query("op13_fill_middle", OP13_SQL)
def op13(spark, sf_dir):
    made = transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
