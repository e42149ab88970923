"""SentencePiece encoding as a relational lattice, and decoding.

A text is split at its blanks into words (each with the blank marks before it), and these where no piece has the two
characters side by side, which changes nothing and leaves fewer and shorter words. Every different word goes
through the lattice once: its substrings of bounded length (no longer than the longest piece with their first three
characters, by a join with these) are exploded, joined to the table of pieces by
equality, the matches grouped by word as edges, and a fold over the edges in order of their ends
keeps the best score and the edge behind it for every position (Viterbi). On equal scores the longer last
piece wins. A character without a piece is an edge below all scores and is written as its UTF-8 bytes.

The words of a text are kept as numbers: a task writes its texts, slice by slice, as lists of word numbers, together with the
words of its batch, to a table bucketed by batch. The encoded words come back by (batch, number) and meet the lists of
their batch, so texts and lists aren't shuffled. The most frequent words of a small sample are encoded
beforehand by the same lattice and sent to the tasks (at most ``SENT_WORDS``, each of at most ``SENT_LENGTH``
characters), the most frequent with the least numbers, which take one byte; this saves their copies in every batch and
changes no result.

Words of more than ``FOLD_LENGTH`` characters that no cut shortens take the same recurrence in a loop over its characters, as a fold over arrays
would copy them at every step.

Pieces and scores are read from the model file (never trained): the score of a path is the sum of its pieces' scores
(``log_scores`` says what the scores of a merge model count as).
Text isn't normalised; a blank before the first word is added as the model asks and taken off by decoding. The blank
mark U+2581 in a text is a blank. Defined cases: null and empty texts have no ids. Rows are encoded each, whatever their ids
(null or repeated). Other columns are ignored. An empty table gives an empty table.
"""

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from basketlens.llm import textbytes
from basketlens.llm.registry import query, table
from basketlens.sources.staging import materialize, materialize_bucketed

BLANK = "▁"
FOLD_LENGTH = 200
BATCH_BYTES = 16 << 20
SENT_WORDS = 300_000
SENT_LENGTH = 32
SAMPLE_TEXTS = 20_000
IDS_AT_ONCE = 1 << 18
CUTS_KEPT = 200_000  # words and parts that a task remembers
COUNTED_AT_ONCE = 50_000  # different words that a task of the sample counts before it hands them on
WORDS_AT_ONCE = 20_000  # per partition of the lattice, so that its edges fit a task's memory
ONE_BYTE = 255  # numbers below take one byte
RUNS = re.compile(" *[^ ]+| +")
UNKNOWN_PENALTY = 10.0
BYTE_PIECE = -1  # an edge of a character without a piece


def log_scores(scores):
    """Scores that add up like log-probabilities.

    A unigram model has log-probabilities. A merge model has whole numbers, minus the rank of each piece; these get the
    log-probability of their rank under Zipf's law. Rounding to multiples of 2**-20 makes sums exact, so ties are ties.
    """
    if any(s != int(s) for s in scores):
        return scores
    n = len(scores)
    total = sum(1 / k for k in range(1, n + 1))
    return [round(-math.log((min(-s, n - 1) + 1) * total) * 2 ** 20) / 2 ** 20 for s in scores]


class Pieces:
    """The pieces of a model file: their scores and ids, and the bytes of every id."""

    def __init__(self, path):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.byte_ids = [i for i in ids if model.is_byte(i)]
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = log_scores([model.get_score(i) for i in plain])
        self.table = {model.id_to_piece(i): (i, s) for i, s in zip(plain, scores)}
        self.unknown = min(s for _, s in self.table.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.table))
        self.kept, self.kept_parts = {}, 0
        self.pairs = {p[k:k + 2] for p in self.table for k in range(len(p) - 1)}
        # The same pairs for arrays of code points, where a blank stands for its mark: a table of the ASCII pairs and all, sorted.
        codes = np.array(sorted(tuple(map(ord, x.replace(BLANK, " "))) for x in self.pairs), np.int64).reshape(-1, 2)
        self.sorted_pairs = codes[:, 0] << 32 | codes[:, 1]
        self.ascii_pairs = np.zeros(1 << 14, bool)
        plain_codes = codes[(codes < 128).all(axis=1)]
        self.ascii_pairs[plain_codes[:, 0] << 7 | plain_codes[:, 1]] = True
        self.texts = [b""] * model.get_piece_size()
        for p, (i, _) in self.table.items():
            self.texts[i] = p.replace(BLANK, " ").encode()
        for value, i in enumerate(self.byte_ids):
            self.texts[i] = bytes([value])
        # Words start with all their blank marks, so no piece may have one after another character.
        for p in self.table:
            if BLANK in p.lstrip(BLANK):
                raise ValueError(f"the piece {p!r} reaches over a word's start")

    def frame(self, spark):
        rows = [(p, i, float(s)) for p, (i, s) in self.table.items()]
        return spark.createDataFrame(rows, "piece STRING, id INT, score DOUBLE")

    def reach(self, spark):
        """(head, reach): the longest piece by the first three characters."""
        longest = {}
        for p in self.table:
            longest[p[:3]] = max(longest.get(p[:3], 0), len(p))
        return spark.createDataFrame(list(longest.items()), "head STRING, reach INT")

    def parts(self, word):
        """``cuts`` of a word, remembered."""
        found = self.kept.get(word)
        if found is None:
            cut = self.cuts(word)
            # Most words have no cut; they are kept as themselves.
            found = (word,) if len(cut) == 1 else tuple(cut)
            if len(word) <= SENT_LENGTH:
                if self.kept_parts + len(cut) > CUTS_KEPT:
                    self.kept.clear()
                    self.kept_parts = 0
                self.kept[word] = found if len(cut) > 1 else word
                self.kept_parts += len(cut)
        return (found,) if type(found) is str else found

    def cuts(self, word):
        """The word in parts between which no piece can reach."""
        at = [0] + [k for k in range(1, len(word)) if word[k - 1:k + 1] not in self.pairs] + [len(word)]
        return [word[a:b] for a, b in zip(at, at[1:])]

    def parts_of(self, texts):
        """(words, counts): the parts of all words of some texts, a blank for each mark, and how many each text has.

        No piece has a mark after another character, so the words' starts are cuts like all others.
        """
        texts = [" " + t.replace(BLANK, " ") if t else "" for t in texts]
        whole = "".join(texts)
        data, codes = whole.encode(), np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        left, right = codes[:-1], codes[1:]
        plain = (left | right) < 128
        joined = plain & self.ascii_pairs[(left << 7 | right) & 0x3FFF]
        other = np.flatnonzero(~plain)
        if other.size and self.sorted_pairs.size:
            wanted = left[other].astype(np.int64) << 32 | right[other]
            place = np.minimum(np.searchsorted(self.sorted_pairs, wanted), self.sorted_pairs.size - 1)
            joined[other] = self.sorted_pairs[place] == wanted
        cut = np.concatenate([[True], ~joined, [True]])[:codes.size + 1]
        cut[bounds] = True
        at = np.flatnonzero(cut)
        counts = np.diff(np.searchsorted(at, bounds))
        if len(data) > codes.size:  # places in bytes
            widths = np.ones(codes.size, np.uint8)
            for limit in (0x80, 0x800, 0x10000):
                widths += codes >= limit
            at = np.concatenate([[0], np.cumsum(np.add.reduceat(widths, at[:-1], dtype=np.int64))])
        return pa.LargeStringArray.from_buffers(at.size - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)), counts

    def viterbi(self, word):
        """Ids of a word by the lattice's recurrence, position by position."""
        best, back = [0.0], [(0, 0)]
        for end in range(1, len(word) + 1):
            top = None
            for start in range(max(0, end - self.longest), end):
                found = self.table.get(word[start:end])
                if found is None and end - start > 1:
                    continue
                i, score = found or (BYTE_PIECE, self.unknown)
                score += best[start]
                if top is None or score > top[0]:
                    top = (score, start, i)
            best.append(top[0])
            back.append(top[1:])
        path, end = [], len(word)
        while end:
            start, i = back[end]
            path.append([i] if i != BYTE_PIECE else [self.byte_ids[b] for b in word[start:end].encode()])
            end = start
        return [i for part in reversed(path) for i in part]


# ---- the lattice ------------------------------------------------------------------------

def encode_words(words, pieces):
    """(word, ids, …) of a frame (word, …) in which words repeat; the other columns say where.

    One exchange by word serves all: the different words, their edges and paths, and the places that these go back to.
    """
    spark = words.sparkSession
    size = F.length("word")
    parts = max(1, -(-words.count() // WORDS_AT_ONCE))
    words = words.repartition(parts, "word")
    different = words.select("word").distinct()
    short = different.where(size <= FOLD_LENGTH)
    # As many pieces as the model has: tables of fixed size.
    known, reach = F.broadcast(pieces.frame(spark)), F.broadcast(pieces.reach(spark))
    width = F.least(F.coalesce("reach", F.lit(2)), size - F.col("start"))
    edges = (short.where(size > 0).select("word", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
             .withColumn("head", F.substring("word", F.col("start") + 1, F.lit(3))).join(reach, "head", "left")
             .select("word", "start", F.explode(F.sequence(F.lit(1), width)).alias("width"))
             .withColumn("piece", F.substring("word", F.col("start") + 1, F.col("width")))
             .join(known, "piece", "left").where("id is not null or width = 1")
             .select("word", F.struct((F.col("start") + F.col("width")).alias("end"), "start",
                                      F.coalesce("id", F.lit(BYTE_PIECE)).alias("id"),
                                      F.coalesce("score", F.lit(pieces.unknown)).alias("score")).alias("edge")))
    lattice = edges.groupBy("word").agg(F.array_sort(F.collect_list("edge")).alias("edges"))

    node = "STRUCT<score: DOUBLE, start: INT, id: INT>"
    first = F.struct(F.array().cast(f"ARRAY<{node}>").alias("nodes"), F.lit(0).alias("end"),
                     F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"), F.lit(0).alias("id")).alias("best"))

    def step(state, e):
        closed = e["end"] > state["end"]
        nodes = F.when(closed, F.concat(state["nodes"], F.array(state["best"]))).otherwise(state["nodes"])
        score = F.get(nodes, e["start"])["score"] + e["score"]
        own = F.struct(score.alias("score"), e["start"].alias("start"), e["id"].alias("id"))
        better = closed | (score > state["best"]["score"])
        return F.struct(nodes.alias("nodes"), e["end"].alias("end"), F.when(better, own).otherwise(state["best"]).alias("best"))

    nodes = lattice.select("word", F.aggregate("edges", first, step, lambda s: F.concat(s["nodes"], F.array(s["best"]))).alias("nodes"))
    part = "STRUCT<start: INT, end: INT, id: INT>"

    def back(state, _):
        own = F.get(F.col("nodes"), state["at"])
        taken = F.struct(own["start"].alias("start"), state["at"].alias("end"), own["id"].alias("id"))
        return F.when(state["at"] > 0, F.struct(own["start"].alias("at"), F.concat(F.array(taken), state["path"]).alias("path"))
                      ).otherwise(state)

    end = F.struct(F.size("nodes").alias("at"), F.array().cast(f"ARRAY<{part}>").alias("path"))
    end = end.withField("at", F.size("nodes") - 1)
    path = nodes.select("word", F.aggregate(F.sequence(F.lit(1), F.size("nodes") - 1), end, back, lambda s: s["path"]).alias("path"))
    lowest = pieces.byte_ids[0] if pieces.byte_ids else 0

    def ids_of(x):
        character = F.hex(F.encode(F.substring("word", x["start"] + 1, x["end"] - x["start"]), "UTF-8"))
        bytes_ = F.transform(F.sequence(F.lit(1), F.length(character) - 1, F.lit(2)),
                             lambda k: F.conv(F.substring(character, k, F.lit(2)), 16, 10).cast("int") + lowest)
        return F.when(x["id"] == BYTE_PIECE, bytes_).otherwise(F.array(x["id"]))

    folded = path.select("word", F.flatten(F.transform("path", ids_of)).alias("ids"))

    def by_characters(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["word"], pa.array([pieces.viterbi(w) for w in batch["word"].to_pylist()], pa.list_(pa.int32()))], ["word", "ids"])

    long = different.where(size > FOLD_LENGTH).mapInArrow(by_characters, folded.schema)
    # Each kind of word goes back to its places on its own, by the same exchange.
    wanted = ["word", "ids", *(c for c in words.columns if c != "word")]
    return (folded.join(words.where(size <= FOLD_LENGTH), "word").select(wanted)
            .union(long.join(words.where(size > FOLD_LENGTH), "word").select(wanted)))


# ---- texts as lists of words ------------------------------------------------------------

def split_words(text, pieces):
    if not text:
        return []
    text = text.replace(BLANK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        words = [w.replace(" ", BLANK) for w in RUNS.findall(" " + text)]
    else:
        words = [BLANK + w for w in text.split(" ")]
    return [part for w in words for part in pieces.parts(w)]


def _count_words(pieces):
    """(word, n), words again and again: a task never holds many, and sums are Spark's."""
    def run(batches):
        from collections import Counter

        def rows(seen):
            kept = [(w, n) for w, n in seen.items() if len(w) <= SENT_LENGTH]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())],
                                              ["word", "n"])
        seen = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(split_words(text.as_py(), pieces))
                if len(seen) >= COUNTED_AT_ONCE:
                    yield rows(seen)
                    seen.clear()
        yield rows(seen)
    return run


class Numbers:
    """Numbers of the words of a batch, from 1 up: those sent beforehand, then the batch's own in order of appearance.

    The first appearance of an own word is 0: its number is one more than that of the own word before it.
    """

    def __init__(self, sent):
        self.sent, self.own = sent, {}

    def of(self, words):
        """The numbers of a column of words, each different one looked up once."""
        coded = words.dictionary_encode()
        places, different = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.sent.get, different, repeat(0)), np.int64, different.size)
        own, low = np.flatnonzero(numbers == 0), len(self.sent) + len(self.own)
        numbers[own] = [self.own.setdefault(w, len(self.sent) + len(self.own) + 1) for w in different[own]]
        if not places.size:
            return numbers
        # Different words are listed as they appear, so a first appearance is above all places before it.
        appears = places > np.concatenate([[-1], np.maximum.accumulate(places)[:-1]])
        return np.where(appears & (numbers > low)[places], 0, numbers[places])


def pack(numbers):
    """Bytes of an array of numbers: one for each, and for those that need more what is left, by place value."""
    rest = (numbers[numbers >= ONE_BYTE] - ONE_BYTE).astype("<u4").view(np.uint8).reshape(-1, 4)
    return pa.compress(np.minimum(numbers, ONE_BYTE).astype(np.uint8).tobytes() + rest.T.tobytes(), codec="zstd", asbytes=True)


def unpack(packed, n):
    data = np.frombuffer(_plain(packed), np.uint8)
    numbers = data[:n].astype(np.int64)
    numbers[numbers == ONE_BYTE] += np.ascontiguousarray(data[n:].reshape(4, -1).T).view("<u4").ravel()
    return numbers


BATCHED = "batch BIGINT, ids ARRAY<BIGINT>, sizes ARRAY<INT>, before INT, packed BINARY, code INT, word STRING"


def _batches_of(pieces, sent):
    """Rows of slices of texts (batch, ids, sizes in words, own words before the slice, packed) and of a batch's own words (batch, code, word)."""
    schema = pa.schema([("batch", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("before", pa.int32()),
                        ("packed", pa.binary()), ("code", pa.int32()), ("word", pa.string())])

    def run(batches):
        # No other task of this stage has the number, and a repeated task writes the same.
        batch_number = TaskContext.get().partitionId() << 32
        numbers, slices, held = Numbers(sent.value), [], 0

        def frame(n, **columns):
            return pa.RecordBatch.from_arrays([pa.array([batch_number] * n, pa.int64()) if f.name == "batch" else
                                               pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                                               for f in schema], schema=schema)

        def rows():
            for ids, sizes, before, packed in slices:
                yield frame(1, ids=[ids], sizes=[sizes], before=[before], packed=[packed])
            own = list(numbers.own)
            for k in range(0, len(own), 50_000):
                some = own[k:k + 50_000]
                yield frame(len(some), code=np.arange(k, k + len(some), dtype=np.int32), word=[w.replace(" ", BLANK) for w in some])

        for batch in batches:
            for low, data, offsets in textbytes.slices(batch["text"]):
                n = offsets.size - 1
                before = len(numbers.own)
                words, sizes = pieces.parts_of(batch["text"].slice(low, n).to_pylist())
                slices.append((batch["id"].slice(low, n).to_pylist(), sizes, before, pack(numbers.of(words))))
                held += data.size
                if held >= BATCH_BYTES:
                    yield from rows()
                    batch_number += 1
                    numbers, slices, held = Numbers(sent.value), [], 0
        if slices:
            yield from rows()
    return run


def _flat(lists):
    """(values, bounds) of lists of numbers."""
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))])
    values = np.fromiter((x for y in lists for x in y), np.int32, int(bounds[-1]))
    return values, bounds


def _assemble(sent_ids):
    def run(texts, words):
        # Ids of all words: those sent, then the batch's own by number.
        values, bounds = sent_ids.value
        order = np.argsort(words["code"].to_numpy())
        lists = words["ids"].combine_chunks()
        own = lists.take(pa.array(order)) if len(order) else lists
        sizes = np.concatenate([np.diff(bounds), np.diff(own.offsets.to_numpy()) if len(order) else np.empty(0, np.int64)]).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if sizes.size else np.empty(0, np.int64)
        flat = np.concatenate([values, own.flatten().to_numpy() if len(order) else np.empty(0, np.int32)])
        out, ends = [], [np.zeros(1, np.int64)]
        for counts, before, packed in zip(texts["sizes"], texts["before"].to_pylist(), texts["packed"]):
            until = np.concatenate([[0], np.cumsum(counts.values.to_numpy(), dtype=np.int64)])
            numbers = unpack(packed.as_py(), int(until[-1]))
            new = np.flatnonzero(numbers == 0)
            numbers[new] = bounds.size + before + np.arange(new.size)
            numbers -= 1
            n = sizes[numbers]
            upto = np.concatenate([[0], np.cumsum(n)])
            out.append(flat[np.arange(upto[-1]) + np.repeat(starts[numbers] - upto[:-1], n)])
            ends.append(ends[-1][-1] + upto[until[1:]])
        joined = pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate(out)))
        return pa.table({"id": pc.list_flatten(texts["ids"]), "ids": joined})
    return run


def _plain(code):
    import zstandard
    return zstandard.ZstdDecompressor().decompress(code, max_output_size=1 << 31)


def encode(docs, model_path, id_column="doc_id", text_column="text"):
    """(id, ids) for every row."""
    spark = docs.sparkSession
    pieces = Pieces(model_path)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    sample = texts.select("text").sample(min(1.0, SAMPLE_TEXTS / max(1, texts.count())), seed=5)
    counted = (sample.mapInArrow(_count_words(pieces), "word STRING, n BIGINT").groupBy("word").agg(F.sum("n").alias("n"))
               .orderBy(F.desc("n"), "word").limit(SENT_WORDS))
    frequent = encode_words(materialize(counted), pieces).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    values, bounds = _flat(frequent["ids"].to_pylist())
    # The numbers of the words and their ids are sent apart: no task needs both.
    sent = spark.sparkContext.broadcast({w.replace(BLANK, " "): k for k, w in enumerate(frequent["word"].to_pylist(), 1)})
    sent_ids = spark.sparkContext.broadcast((values, bounds))

    batched = materialize_bucketed(texts.mapInArrow(_batches_of(pieces, sent), BATCHED), ["batch"])
    words = batched.where("word is not null").select("word", "batch", "code")
    encoded = encode_words(words, pieces).select(F.col("batch").alias("of"), "code", "ids")
    lists = batched.where("packed is not null").select("batch", "ids", "sizes", "before", "packed")
    found = (lists.groupBy("batch").cogroup(encoded.groupBy("of"))
             .applyInArrow(_assemble(sent_ids), "id BIGINT, ids ARRAY<INT>"))
    return found.withColumnRenamed("id", id_column)


def decode(ids, model_path):
    """The text of a column of ids."""
    texts = Pieces(model_path).texts
    sizes = np.array([len(t) for t in texts], np.int64)
    starts, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(texts), np.uint8)

    def some(lists):
        """Texts of a slice of id lists, by places in the bytes of all pieces."""
        bounds, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
        values, bounds = values[bounds[0]:bounds[-1]], bounds - bounds[0]
        lengths = sizes[values]
        until = np.concatenate([[0], np.cumsum(lengths)])
        data = flat[np.arange(until[-1]) + np.repeat(starts[values] - until[:-1], lengths)]
        edges = until[bounds]
        low, high = edges[:-1], edges[1:]
        # The blank that was put before the first word.
        low = low + ((high > low) & (np.append(data, 0)[low] == 32))
        raw = data.tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(low.tolist(), high.tolist())]

    @F.arrow_udf("STRING")
    def joined(column: pa.Array) -> pa.Array:
        filled = column.fill_null(pa.scalar([], column.type)) if column.null_count else column
        counts = np.diff(filled.offsets.to_numpy().astype(np.int64))
        # Slices of about so many ids; a longer text is one.
        cuts = np.flatnonzero(np.diff(np.cumsum(counts) // IDS_AT_ONCE, prepend=0)).tolist()
        cuts = [0, *(k for k in cuts if k), len(counts)]
        made = [pa.array(some(filled.slice(a, b - a)), pa.string()) for a, b in zip(cuts, cuts[1:]) if b > a]
        out = pa.concat_arrays(made) if made else pa.array([], pa.string())
        return pc.if_else(column.is_null(), pa.scalar(None, pa.string()), out) if column.null_count else out

    return joined(ids)


@query("op2_piece_lattice")
def op2(spark, sf_dir):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode(table(spark, sf_dir, "documents"), model)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.sha2(decode(F.col("ids"), model), 256).alias("decoded_sha256"))
