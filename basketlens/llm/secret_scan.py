"""Secret scanning: fixed patterns, and Markov models of random strings and of ordinary identifiers.

Everything on the main path is DataFrame functions. A text is first cut into segments of about ``SEGMENT`` code points,
at places that no match can contain, so that the work on a text grows with its length, however many matches it has; only a
stretch without any such place is a longer segment. Positions in a segment come from splitting it at its matches: the lengths of
the pieces between and of the matches add up to the offsets, in code points.

Two first-order character models are trained from labelled samples: the values that the fixed
patterns find (random strings), and the other words (ordinary identifiers). Both are smoothed tables of character pairs. A candidate is a run of token characters
outside the base spans, of any length; it is a secret when the mean log-likelihood ratio of its pairs is above the
threshold. Below ``ASSIGN_LEAST`` characters, the least that the fixed patterns count as a value, few pairs could
be above it by chance, so there the summed ratio must be above that of ``SHORT_PAIRS`` pairs at the threshold. Runs
without any pair above the threshold can't be secrets and aren't scored. Training takes labelled documents only, up to fixed numbers of them (``SECRET_DOCUMENTS``,
``WORD_DOCUMENTS``, chosen by a hash of the id); scanning covers all texts.

Defined cases: a null or empty text has no spans. Overlapping finds of different kinds are all
kept; a run that overlaps base spans is cut at them, and what is left on each side is a candidate of its own. A table without any labelled secret has
no positive sample, so it gets base spans only. Repeated rows are scanned each; a null id stays.
"""

import math
import re

from pyspark.sql import functions as F

from basketlens.llm.ordered import bounded_sample
from basketlens.llm.registry import query, table

# Fixed patterns of the base kinds, in their order, with the group whose length counts.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
KINDS = ["assign", "access", "hex", "markov"]
ASSIGN_LEAST = 12

# What the models see: runs of token characters.
TOKEN = "[A-Za-z0-9+/_=-]"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
WORD = TOKEN + "++"
THRESHOLD = 0.5  # mean log-likelihood ratio (nats) per pair
SHORT_PAIRS = 15  # a run of under ASSIGN_LEAST characters needs the evidence of so many pairs
SMOOTHING = 0.5
SECRET_DOCUMENTS = 20_000
WORD_DOCUMENTS = 4_000
MASK = "[SECRET]"

SEGMENT = 4_096
# A cut lies behind a character that no pattern has, or between the words of "ab cd": no match has a space there.
CUT = r"""(?<=[^A-Za-z0-9+/_.=\-"':\x20])|(?<=[A-Za-z0-9+/_.\-]\x20)(?=[A-Za-z0-9])"""
SEGMENTS = r"(?s).{%d}.*?(?:%s|\z)|.+" % (SEGMENT, CUT)
GROUP = 1_024

SPAN = "STRUCT<start: BIGINT, end: BIGINT, kind: INT, value: STRING>"


def _once(value, use):
    """``use(value)`` with the value computed once for each row."""
    return F.transform(F.array(value), use)[0]


def segments(text):
    """The text in pieces, none of which cuts a match; their concatenation is the text."""
    return F.when(F.length(text) > SEGMENT, F.regexp_extract_all(text, F.lit(SEGMENTS), F.lit(0))).otherwise(F.array(text))


def _sums(values):
    """0 and the running sums of a short array."""
    add = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    return F.aggregate(values, F.array(F.lit(0).cast("long")), add)


def _before(lengths):
    """The sum of the lengths before each, in groups and over the groups, so that no long array grows element by element."""
    last = F.floor((F.size(lengths) - 1) / GROUP).cast("int")
    groups = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda g: _sums(F.slice(lengths, g * GROUP + 1, GROUP)))

    def joined(inner):
        totals = _sums(F.transform(inner, lambda x: F.element_at(x, -1)))
        return _once(totals, lambda t: F.flatten(F.transform(inner, lambda x, g: F.transform(
            F.slice(x, 1, F.size(x) - 1), lambda v: v + F.get(t, g)))))

    return _once(groups, joined)


def _spans(text, pattern, kind, wanted=lambda value: F.lit(True)):
    """Array of (start, end, kind, value) of the leftmost non-overlapping matches in a segment whose value is wanted."""
    empty = F.array().cast(f"ARRAY<{SPAN}>")

    def step(state, x):
        start = state["at"] + F.length(x["before"])
        end = start + F.length(x["value"])
        span = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"),
                        F.lit(kind).alias("kind"), x["value"].alias("value"))
        # The last piece has no match after it.
        return F.struct(F.coalesce(end, start).cast("long").alias("at"),
                        F.when(x["value"].isNotNull() & wanted(x["value"]), F.concat(state["spans"], F.array(span)))
                        .otherwise(state["spans"]).alias("spans"))

    def placed(found):
        steps = F.arrays_zip(F.split(text, pattern, -1).alias("before"), found.alias("value"))
        first = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))
        return F.when(F.size(found) > 0, F.aggregate(steps, first, step, lambda s: s["spans"])).otherwise(empty)

    return _once(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def base_spans(text):
    """Spans of the fixed patterns in a segment, by start and then kind; matches that are too short are dropped."""
    assign = F.filter(_spans(text, ASSIGN, 0),
                      lambda s: F.length(F.regexp_extract(s["value"], ASSIGN_VALUE, 1)) >= ASSIGN_LEAST)
    return F.array_sort(F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


# ---- the two Markov models --------------------------------------------------------------

def _pairs(value):
    """The numbers of the adjacent character pairs of a token, an array."""
    def number(i):
        first = F.instr(F.lit(ALPHABET), F.substring(value, i, F.lit(1)))
        second = F.instr(F.lit(ALPHABET), F.substring(value, i + 1, F.lit(1)))
        return (first - 1) * len(ALPHABET) + second - 1

    return F.when(F.length(value) > 1, F.transform(F.sequence(F.lit(1), F.length(value) - 1), number)).otherwise(F.array().cast("ARRAY<INT>"))


def _pair_counts(tokens):
    """{pair number: count} of a frame of tokens; the alphabet bounds its size."""
    counted = tokens.groupBy("token").agg(F.count("*").alias("n"))
    pairs = counted.select("n", F.explode(_pairs(F.col("token"))).alias("pair"))
    return {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()}


def train_ratios(secrets, words):
    """Log-likelihood ratio of each character pair, or None without any labelled secret.

    Both arguments are frames of one column, ``token``. The transitions out of each character are
    smoothed, so unseen pairs have a finite ratio.
    """
    size = len(ALPHABET)
    logs = []
    for tokens in (secrets, words):
        counts = _pair_counts(tokens)
        if not counts and not logs:
            return None
        totals = [sum(counts.get(a * size + b, 0) for b in range(size)) for a in range(size)]
        logs.append([math.log((counts.get(a * size + b, 0) + SMOOTHING) / (totals[a] + SMOOTHING * size))
                     for a in range(size) for b in range(size)])
    return [x - y for x, y in zip(*logs)]


def learn(docs, labels, id_column="doc_id", text_column="text"):
    """Ratios learnt from labelled documents: what the fixed patterns find there, and the other words."""
    def chosen(most):
        # At most this many ids: the broadcast has a fixed size.
        ids = bounded_sample(labels.select(F.col(id_column).alias("id")).where("id is not null").distinct(), "id", most, 17)
        return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(ids), "id", "left_semi")

    text = F.col("text")
    found = (chosen(SECRET_DOCUMENTS).select(F.explode(segments(text)).alias("text"))
             .select(F.explode(base_spans(text)["value"]).alias("value")))
    value = F.regexp_extract("value", ASSIGN_VALUE, 1)
    secrets = found.select(F.when(value != "", value).otherwise(F.col("value")).alias("token"))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = chosen(WORD_DOCUMENTS).select(F.explode(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))).alias("token"))
    return train_ratios(secrets, words)


def _screen(ratios, threshold):
    """Pattern of the runs that hold a pair above the threshold: no mean can be above it without one."""
    size = len(ALPHABET)
    above = [(a, [b for j, b in enumerate(ALPHABET) if ratios[i * size + j] >= threshold]) for i, a in enumerate(ALPHABET)]
    pairs = _one_of([(re.escape(a), "".join(map(re.escape, b))) for a, b in above if b])
    return f"(?<!{TOKEN}){TOKEN}*?(?:{pairs}){TOKEN}*+" if pairs else None


def _one_of(pairs):
    """Pattern of the listed pairs: halves of the list by their first characters, so that few branches are tried."""
    if len(pairs) < 3:
        return "|".join(f"{a}[{b}]" for a, b in pairs)
    half = len(pairs) // 2
    return f"(?=[{''.join(a for a, _ in pairs[:half])}])(?:{_one_of(pairs[:half])})|(?:{_one_of(pairs[half:])})"


def _blanked(text, spans):
    """The text with spaces in place of the spans, so that offsets stay."""
    def step(state, s):
        kept = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], state["at"]), F.lit(0)).cast("int"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], kept, blank).alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, first, step, rest)).otherwise(text)


def scan_segments(text, ratios, threshold=THRESHOLD):
    """(text, base, spans) of each segment of a text; the spans (start, end, kind, value) count from the segment's start."""
    screen = ratios and _screen(ratios, threshold)
    # One constant array: the optimizer folds the text into a literal.
    table_of_ratios = F.split(F.lit(",".join(map(repr, ratios or [0.0]))), ",").cast("ARRAY<DOUBLE>")

    def secret(value):
        total = F.aggregate(_pairs(value), F.lit(0.0), lambda s, p: s + F.get(table_of_ratios, p))
        pairs = F.when(F.length(value) < ASSIGN_LEAST, SHORT_PAIRS).otherwise(F.length(value) - 1)
        return total > F.lit(threshold) * pairs

    def joined(base, rest):
        # Each different run of a segment is scored once; positions are only needed where one is a secret.
        values = F.filter(F.array_distinct(F.regexp_extract_all(rest, F.lit(screen), F.lit(0))), secret)
        found = lambda v: _spans(rest, screen, 3, lambda value: F.array_contains(v, value))
        return _once(values, lambda v: F.when(F.size(v) > 0, F.array_sort(F.concat(base, found(v)))).otherwise(base))

    def judged(segment):
        def both(base):
            spans = base if not screen else _once(_blanked(segment, base), lambda rest: joined(base, rest))
            return F.struct(segment.alias("text"), base.alias("base"), spans.alias("spans"))
        return _once(base_spans(segment), both)

    return F.transform(segments(text), judged)


def scan(text, ratios, threshold=THRESHOLD):
    """(base, all): arrays of spans (start, end, kind, value) of a text, by start and then kind."""
    parts = scan_segments(text, ratios, threshold)
    return _once(parts, lambda p: whole(p, "base")), _once(parts, lambda p: whole(p, "spans"))


def whole(parts, name):
    """The spans of all segments, counted from the text's start."""
    moved = lambda s, by: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["kind"].alias("kind"),
                                   s["value"].alias("value"))
    starts = _once(F.transform(parts, lambda p: F.length(p["text"]).cast("long")), _before)
    many = _once(starts, lambda at: F.flatten(F.transform(parts, lambda p, i: F.transform(p[name], lambda s: moved(s, F.get(at, i))))))
    return F.when(F.size(parts) == 1, parts[0][name]).otherwise(many)


def written(spans):
    """kind:start:end, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text, spans, mask=MASK):
    """The text with every span (overlapping ones together) replaced by the mask."""
    def step(state, s):
        fresh = s["start"] >= state["at"]
        kept = F.when(fresh, F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")),
                                      F.lit(mask))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), kept.alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, first, step, rest)).otherwise(text)


def masked_text(parts, mask=MASK):
    """The text of ``scan_segments`` with their spans masked; null where there are none."""
    hit = F.exists(parts, lambda p: F.size(p["spans"]) > 0)
    return F.when(hit, F.array_join(F.transform(parts, lambda p: masked(p["text"], p["spans"], mask)), ""))


def find_secrets(docs, ratios, id_column="doc_id", text_column="text"):
    """(id, base, spans) for every row."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    parts = docs.select(F.col(id_column), text.alias("_text")).select(id_column, scan_segments(F.col("_text"), ratios).alias("_parts"))
    return parts.select(id_column, whole(F.col("_parts"), "base").alias("base"), whole(F.col("_parts"), "spans").alias("spans"))


@query("op9_secret_scan")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    ratios = learn(docs, table(spark, sf_dir, "labels"))
    found = find_secrets(docs, ratios)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
                        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
