"""Mix sources by temperature: weights from exponentiated token shares, drawn as block permutations.

A source with token share p gets a weight in proportion to p**a. The exponent a is the largest in [0, 1]
whose mix has the target entropy (a fraction of the largest possible, log of the number of
sources), but never so small that a source would be repeated more often than the limit: there the
limit wins. Both conditions are monotone in a, so a is found by bisection, many cuts to a pass over the
table of sources.

A source's quota is its weight times the token budget. Its documents fall by hash into blocks of about
``BLOCK_TOKENS`` tokens. A quota of q tokens takes as many whole passes over the source as fit; in the last,
partial pass the blocks come in the order of a hash of the pass, and the block at the cut gives its documents in
hash order until the quota is met. So the decision about a document compares its own hashes with three numbers
of its source, and texts never move: only (source, hash, tokens) is grouped, in parts, also for a
source with a third of all rows.

The budget is a number of tokens (default: those there are), or ``COVER``: the smallest budget that
takes every document at least once, so that rare sources are repeated and nothing is dropped.

Tokens are runs of visible characters, at least one per document. Defined cases: a null source counts
as the empty name; null and empty texts count one token; rows equal in id, source and text
share their hashes and are taken or left together. One source gets the whole budget. An empty table gives
an empty table. All columns pass through.
"""

import math

from pyspark.sql import Window, functions as F

from basketlens.llm.ordered import running_totals
from basketlens.llm.registry import query, table
from basketlens.operators.skew import attach_by_key
from basketlens.sources.staging import materialize

COVER = "cover"
TARGET_ENTROPY = 0.98
MOST_REPEATS = 4.0
BLOCK_TOKENS = 1_000_000
CUTS, PASSES = 16, 6  # bisection: 16**6 steps of the exponent


def _narrow(docs, id_column, text_column, source_column, seed):
    return docs.select(F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("source"),
                       F.xxhash64(F.col(id_column), F.col(text_column), F.lit(seed)).alias("key"),
                       F.greatest(F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(r"\S++")), F.lit(1))
                       .cast("long").alias("tokens"))


def _measures(logs, exponents, budget_share):
    """For each exponent: (entropy, most repeats, p/w at most, sum of p**a) over the sources."""
    wanted = []
    for k, a in enumerate(exponents):
        power = F.exp(F.lit(a) * F.col("log_share"))
        wanted += [F.sum(power).alias(f"z{k}"), F.sum(power * F.col("log_share")).alias(f"s{k}"),
                   F.max(F.exp(F.lit(a - 1) * F.col("log_share"))).alias(f"r{k}"),
                   F.max(F.exp(F.lit(1 - a) * F.col("log_share"))).alias(f"c{k}")]
    row = logs.agg(*wanted).first()
    out = []
    for k, a in enumerate(exponents):
        z, s, r, c = (row[f"{x}{k}"] for x in "zsrc")
        cover = c * z  # largest share by weight
        repeats = r / z * (cover if budget_share is None else budget_share)
        out.append((math.log(z) - a * s / z, repeats, cover, z))
    return out


def find_exponent(sources, budget_share=1.0, target_entropy=TARGET_ENTROPY, most_repeats=MOST_REPEATS):
    """The exponent for a table of sources with ``log_share``. ``budget_share``: budget by tokens, None to cover."""
    n = sources.count()
    if n < 2:
        return 1.0

    def bisect(holds):
        """Smallest a in [0, 1] for which ``holds``, false below and true above (or 1)."""
        low, high = 0.0, 1.0
        if holds(_measures(sources, [0.0], budget_share)[0]):
            return 0.0
        for _ in range(PASSES):
            cuts = [low + (high - low) * k / CUTS for k in range(1, CUTS)]
            true = [holds(m) for m in _measures(sources, cuts, budget_share)]
            k = true.index(True) if True in true else len(true)
            low, high = ([low] + cuts)[k], (cuts + [high])[k]
        return high

    # Entropy falls and repeats fall as the exponent grows.
    by_entropy = bisect(lambda m: m[0] <= target_entropy * math.log(n))
    by_repeats = 0.0 if most_repeats is None else bisect(lambda m: m[1] <= most_repeats)
    return max(by_entropy, by_repeats)


def plan_mix(docs, budget=None, target_entropy=TARGET_ENTROPY, most_repeats=MOST_REPEATS, block_tokens=BLOCK_TOKENS,
             id_column="doc_id", text_column="text", source_column="source", seed=42):
    """One row per source: tokens, share, weight, quota, whole passes, and where the partial pass is cut."""
    narrow = materialize(_narrow(docs, id_column, text_column, source_column, seed))
    totals = materialize(narrow.groupBy("source").agg(F.sum("tokens").alias("n"), F.count("*").alias("documents")))
    total = totals.agg(F.sum("n")).first()[0] or 0
    sources = totals.withColumn("log_share", F.log(F.col("n") / F.lit(float(max(total, 1)))))
    share = None if budget == COVER else (total if budget is None else budget) / max(total, 1)
    a = find_exponent(sources, share, target_entropy, most_repeats)
    measures = _measures(sources, [a], share)[0] if total else (0.0, 0.0, 1.0, 1.0)
    tokens = total * (measures[2] if share is None else share)
    planned = (sources.withColumn("weight", F.exp(F.lit(a) * F.col("log_share")) / measures[3])
               .withColumn("quota", F.col("weight") * F.lit(float(tokens)))
               .withColumn("passes", F.floor(F.col("quota") / F.col("n") + 1e-9).cast("long"))
               .withColumn("rest", F.greatest(F.round(F.col("quota") - F.col("passes") * F.col("n")), F.lit(0)).cast("long"))
               .withColumn("blocks", F.ceil(F.col("n") / block_tokens).cast("long")))
    planned = materialize(planned)
    dealt = attach_by_key(narrow, planned.select("source", "passes", "rest", "blocks", "documents"), ["source"], "documents")
    dealt = dealt.where("rest > 0").select("source", "rest", "tokens", *_places("key", "passes", "blocks", "source", seed))
    blocks = running_totals(dealt.groupBy("source", "block").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest")),
                            "source", ["block"], "tokens")
    # One block per source holds the cut.
    cut = blocks.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("tokens"))).select(
        "source", F.col("block").alias("cut_block"), (F.col("rest") - F.col("before")).alias("left"))
    inside = (dealt.join(cut.withColumnRenamed("cut_block", "block"), ["source", "block"])
              .groupBy("source", "place").agg(F.sum("tokens").alias("tokens"), F.first("left").alias("left")))
    order = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = (inside.withColumn("taken", F.sum("tokens").over(order)).where("taken <= left")
            .groupBy("source").agg(F.max("place").alias("cut_place")))
    return planned.join(cut.drop("left"), "source", "left").join(last, "source", "left")


def _places(key, passes, blocks, source, seed):
    """Order of a document's block in the partial pass, and of the document in its block."""
    block = F.pmod(F.col(key), F.col(blocks))
    return (F.xxhash64(F.lit(seed), F.col(passes), F.col(source), block).alias("block"),
            F.xxhash64(F.lit(seed), F.col(passes), F.col(key)).alias("place"))


def _free(taken, names):
    """The names, with underscores after those that are taken (column names don't tell upper from lower case)."""
    taken, out = {c.lower() for c in taken}, []
    for name in names:
        while name and name.lower() in taken:
            name += "_"
        taken.add((name or "").lower())
        out.append(name)
    return out


def mix(docs, plan, id_column="doc_id", text_column="text", source_column="source", pass_name="pass", seed=42,
        order_names=None):
    """The drawn documents with the number of the pass (from 0) that drew them.

    ``order_names``: names of two more columns, the order of a document's block in its pass and its place in the block.
    Sorted by them, the rows of a source and pass are a permutation of its blocks. Where ``docs`` has a column of such a
    name, the new column's name gets underscores until it is free.
    """
    keep = docs.columns
    pass_name, *order_names = _free(keep, [pass_name, *(order_names or [])])
    rows = docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("source"),
                       F.xxhash64(F.col(id_column), F.col(text_column), F.lit(seed)).alias("key"))
    decided = attach_by_key(rows, plan.select("source", "passes", "rest", "blocks", "cut_block", "cut_place", "documents"),
                            ["source"], "documents")
    block, place = _places("key", "passes", "blocks", "source", seed)
    # Without a cut block the rest holds the whole source or nothing.
    partial = (F.col("rest") > 0) & (F.col("cut_block").isNull() | (block < F.col("cut_block")) |
                                     ((block == F.col("cut_block")) & (place <= F.col("cut_place"))))
    copies = F.col("passes") + F.when(F.coalesce(partial, F.lit(False)), 1).otherwise(0)
    drawn = decided.select("row", "source", "key", "blocks", copies.alias("copies")).where("copies > 0")
    passes = drawn.select("row", "source", "key", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("_pass"))
    places = [p.alias(n) for p, n in zip(_places("key", "_pass", "blocks", "source", seed), order_names)] if order_names else []
    return passes.select(*[F.col("row")[c].alias(c) for c in keep], *([F.col("_pass").alias(pass_name)] if pass_name else []), *places)


@query("op8_source_mix")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, plan_mix(docs), order_names=("block", "place")).select("doc_id", "source", "pass", "block", "place")
