"""Token ids in Parquet files that can be read selectively.

Each row is one document: id, number of tokens, place of its first token among the tokens of its
file, and the list of ids. Files follow each other in ascending document id, so with the token
totals of the files (a column of numbers, no ids read) every document has a place in the whole
stream. Row groups are small, ids are dictionary encoded, the sorted and counting columns are delta
encoded (format 2 pages), and page indexes let a reader of some documents skip the other pages.

Encoding runs on whole texts, once they are sorted. ASCII white space never is inside a token and
is dropped by the tokenizer used here, so a text's ids are those of its blank-separated chunks in
order, and a worker process encodes a repeated chunk once (found by a hash, taken by its bytes). A chunk of ASCII letters and a
final comma or full stop is encoded in these two parts, if the tokenizer separates them, and in lower case, if it folds case.

Defined cases: a null or empty text has only the end id. Rows with equal document ids, or without
one (these come first), stay separate rows next to each other. Other columns are ignored. An empty
table gives files without rows.
"""

import itertools
import re
import uuid
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window, functions as F

from basketlens.llm import textbytes
from basketlens.llm.registry import query, table
from basketlens.sources.staging import remember, shared_folder

CACHED_CHUNKS = 1_000_000  # a worker's memory for chunks; it starts anew beyond that
CHUNKS_AT_ONCE = 1024
LETTERS_BELOW = 0x530  # Latin, Greek, Cyrillic
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}
SCHEMA = "part INT, doc_id BIGINT, local_start BIGINT, n_tokens BIGINT, ids ARRAY<INT>"


class _Chunks:
    """Ids of chunks, kept for the worker process and its tokenizer.

    A chunk is looked up by a 64-bit hash and taken only if its bytes are those kept for the hash; one that shares
    its hash with another is kept by its bytes.
    """

    def __init__(self, definition, end_id):
        import os
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.end_id = end_id
        ids = self._ids
        self.marks = [m for m in b",." if ids(f"ab{chr(m)}") == ids("ab") + ids(chr(m))]
        self.mark_ids = {chr(m): ids(chr(m)) for m in self.marks}
        self.folds = ids("AB") == ids("ab")
        self._find_letters()
        self.clear()

    def _ids(self, text):
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def clear(self):
        """Slot 0 is the end id, the next ones are the marks; they have no bytes."""
        self.slots, self.rare = {}, {}
        self.flat, self.starts, self.raw, self.edges = array("i"), array("q", [0]), bytearray(), array("q", [0])
        for ids in ([self.end_id], *self.mark_ids.values()):
            self._add([b""], np.array(ids, np.int32), [len(ids)])

    def _add(self, chunks, ids, sizes):
        """Keep chunks with their ids, given one after the other; the number of the first one's slot."""
        first, end, edge = len(self.starts) - 1, len(self.flat), len(self.raw)
        self.flat.frombytes(ids.astype(np.int32).tobytes())
        self.starts.frombytes((end + np.cumsum(sizes, dtype=np.int64)).tobytes())
        self.raw += b"".join(chunks)
        self.edges.frombytes((edge + np.cumsum([len(c) for c in chunks], dtype=np.int64)).tobytes())
        return first

    def _find_letters(self):
        """The letters whose words the tokenizer's model encodes as they are, each with what the model is given for it.

        Letters are never joined to their neighbours by normalisation, and a word of letters is one piece to the model, so each
        letter is tried alone and between others. A word with another character goes through the whole tokenizer.
        """
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in printable)
        byte_signs = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.letters = {}
        for c in filter(str.isalpha, map(chr, range(LETTERS_BELOW))):
            given = "".join(byte_signs[b] for b in (c.lower() if self.folds else c).encode())
            if all(self._model_ids(a + given + b) == self._ids(a + c + b) for a, b in (("", ""), ("x", ""), ("", "x"), ("x", "x"))):
                self.letters[ord(c)] = given
        plain = [chr(c) for c in range(128) if chr(c).isalpha() and (chr(c).islower() or not self.folds)]
        self.ascii = all(self.letters.get(ord(c)) == c for c in plain)
        letters, marks = "".join(map(chr, self.letters)), re.escape("".join(map(chr, self.marks)))
        self.word = re.compile(f"([{letters}]+)([{marks}]?)" if marks else f"([{letters}]+)()") if letters else re.compile("(?!)")

    def _model_ids(self, given):
        return [t.id for t in self.tokenizer.model.tokenize(given)]

    def _learn(self, chunks):
        """Encode new chunks and keep them; the number of the first one's slot."""
        found, rest, tokenize, match = [None] * len(chunks), [], self.tokenizer.model.tokenize, self.word.fullmatch
        for k, chunk in enumerate(chunks):
            text = chunk.decode("utf-8", "replace")
            if self.ascii and text.isalpha() and text.isascii() and (not self.folds or text.islower()):
                found[k] = [t.id for t in tokenize(text)]  # every letter stands for itself
            elif word := match(text):
                found[k] = [t.id for t in tokenize(word[1].translate(self.letters))]
                if word[2]:
                    found[k] += self.mark_ids[word[2]]
            else:
                rest.append((k, text))
        for (k, _), e in zip(rest, self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False)):
            found[k] = e.ids
        return self._add(chunks, np.fromiter(itertools.chain.from_iterable(found), np.int32), [len(ids) for ids in found])

    def _slots_of(self, data, starts, ends):
        """The slot of each chunk."""
        hashes = textbytes.span_hash(textbytes.prefix_hash(data), starts, ends)
        back, different = pd.factorize(hashes)
        at = np.empty(different.size, np.int64)
        at[back[::-1]] = np.arange(back.size)[::-1]
        keys = different.tolist()
        known = np.array([self.slots.get(key, -1) for key in keys], np.int64)
        fresh = np.flatnonzero(known < 0)
        raw = data.tobytes()
        for few in range(0, fresh.size, CHUNKS_AT_ONCE):
            some = fresh[few:few + CHUNKS_AT_ONCE]
            first = self._learn([raw[a:b] for a, b in zip(starts[at[some]].tolist(), ends[at[some]].tolist())])
            known[some] = np.arange(first, first + some.size)
            self.slots.update(zip([keys[k] for k in some.tolist()], range(first, first + some.size)))
        slot = known[back]
        for k in np.flatnonzero(~self._same(data, starts, ends, slot)).tolist():
            chunk = raw[starts[k]:ends[k]]
            if chunk not in self.rare:
                self.rare[chunk] = self._learn([chunk])
            slot[k] = self.rare[chunk]
        return slot

    def _same(self, data, starts, ends, slot):
        """Whether each chunk's bytes are those of its slot."""
        edges, kept = np.frombuffer(self.edges, np.int64), np.frombuffer(self.raw, np.uint8)
        sizes = ends - starts
        same = edges[slot + 1] - edges[slot] == sizes
        at = np.flatnonzero(same & (sizes > 0))
        until = np.cumsum(sizes[at])
        if until.size:
            steps = np.arange(until[-1])
            equal = (data[steps + np.repeat(starts[at] - until + sizes[at], sizes[at])]
                     == kept[steps + np.repeat(edges[slot[at]] - until + sizes[at], sizes[at])])
            same[at] = np.logical_and.reduceat(equal, until - sizes[at])
        return same

    def encode(self, data, offsets):
        """(ids of all texts one after the other, each with the end id; bounds of the texts)."""
        if len(self.starts) > CACHED_CHUNKS or len(self.flat) > 16 * CACHED_CHUNKS or len(self.raw) > 16 * CACHED_CHUNKS:
            self.clear()
        starts, ends, first = textbytes.words(data, offsets)
        # A chunk of ASCII letters with a mark after it is two units, the letters in lower case.
        letters = np.concatenate([[0], np.cumsum(LETTER[data], dtype=np.int64)])
        last = data[ends - 1]
        mark = np.zeros(starts.size, np.int64)
        for k, m in enumerate(self.marks):
            mark[(last == m) & (ends - starts > 1)] = k + 1
        plain = letters[ends - (mark > 0)] - letters[starts] == ends - (mark > 0) - starts
        mark[~plain] = 0
        ends = ends - (mark > 0)
        if self.folds:
            edge = np.zeros(data.size + 1, np.int8)
            edge[starts[plain]] = 1
            edge[ends[plain]] -= 1
            data = np.where(np.cumsum(edge[:-1], dtype=np.int8) > 0, textbytes.LOWER[data], data)
        slot = self._slots_of(data, starts, ends)
        # Units in order: each chunk, its mark if it has one, and the end after each text.
        texts = first.size - 1
        marked = np.concatenate([[0], np.cumsum(mark > 0)])
        place = np.arange(starts.size) + marked[:-1] + np.repeat(np.arange(texts), np.diff(first))
        closing = first[1:] + marked[first[1:]] + np.arange(texts)
        units = np.zeros(starts.size + int(marked[-1]) + texts, np.int64)
        units[place] = slot
        units[place[mark > 0] + 1] = mark[mark > 0]
        bounds, flat = np.frombuffer(self.starts, np.int64), np.frombuffer(self.flat, np.int32)
        sizes = (bounds[1:] - bounds[:-1])[units]
        until = np.cumsum(sizes)
        ids = flat[np.arange(until[-1]) + np.repeat(bounds[units] - until + sizes, sizes)]
        return ids, np.concatenate([[0], until[closing]])


_chunks = {}  # of this process


def _encoder(definition, end_id):
    """A function of Arrow batches (doc_id, text) in order; its counts are one task's."""
    def run(batches):
        key = (definition.value, end_id)
        if key not in _chunks:
            _chunks.clear()
            _chunks[key] = _Chunks(*key)
        start, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            for low, data, offsets in textbytes.slices(batch["text"], 2 * textbytes.SLICE_BYTES):
                ids, bounds = _chunks[key].encode(data, offsets)
                n = bounds.size - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), batch["doc_id"].slice(low, n), pa.array(start + bounds[:-1]),
                     pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))],
                    ["part", "doc_id", "local_start", "n_tokens", "ids"])
                start += int(bounds[-1])
    return run


def write_tokens(docs, path, tokenizer_path, end_id, id_column="doc_id", text_column="text"):
    """Encode every text and write the files in ascending document id.

    The sort takes a row's position as the last key, so many rows with one id still spread over
    tasks. The tokenizer's definition (one file of fixed size) is sent to the tasks as text.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
                       F.monotonically_increasing_id().alias("place"))
    ordered = (rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
               .select("doc_id", "text"))
    ordered.mapInArrow(_encoder(definition, end_id), SCHEMA).write.options(**FILE_OPTIONS).parquet(path)


def read_index(spark, path):
    """(doc_id, start, n_tokens, part, local_start): reads no ids."""
    files = spark.read.schema(SCHEMA).parquet(path).select("doc_id", "n_tokens", "part", "local_start")
    return _placed(files)


def read_tokens(spark, path, first=None, last=None):
    """(doc_id, start, n_tokens, ids) of the documents with ids from ``first`` to ``last``."""
    files = spark.read.schema(SCHEMA).parquet(path)
    chosen = files
    if first is not None:
        chosen = chosen.where(F.col("doc_id") >= first)
    if last is not None:
        chosen = chosen.where(F.col("doc_id") <= last)
    return _placed(chosen, files).select("doc_id", "start", "n_tokens", "ids")


def _placed(chosen, files=None):
    # One row per file: its tokens, then those of all files before it.
    totals = (files or chosen).groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    return (chosen.join(F.broadcast(offsets), "part")
            .withColumn("start", F.col("offset") + F.col("local_start")).drop("offset"))


def _checksums(batches):
    for batch in batches:
        lists = batch["ids"]
        values = lists.values.to_numpy().astype("<u4")
        bounds = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in itertools.pairwise(bounds.tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"])


@query("op6_token_files")
def op6(spark, sf_dir):
    import public_tokenizers

    path = remember(spark, f"{shared_folder(spark)}/tokens/{uuid.uuid4().hex}")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_tokens(spark, path).mapInArrow(
        _checksums, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
