"""The corpus pipeline: toxicity, near-duplicates, secrets, source mix, tokens.

``STAGES`` are (name, function) pairs. A function takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the next stage's ``docs``. Each stage works on all rows it is given:

1. ``toxicity``: rows that the ordinal model, trained on ``labels``, finds toxic go.
2. ``near_duplicates``: one row of each group of near-duplicates stays (the smallest id); rows without words stay.
3. ``secrets``: found secrets are replaced by a mask, the rest of the text stays; ``n_chars`` follows the text.
4. ``source_mix``: rare sources are repeated up to ``MIX_REPEATS`` times, so that the mix is flatter; the budget covers
   every document, so none is dropped.
5. ``pieces``: every text as token ids: document id, number of tokens, ids.

All but the last return the columns they were given. Rows with null ids or texts, repeated rows and empty tables pass
through as the operators define it.
"""

import uuid

import public_tokenizers
from pyspark.sql import functions as F

from basketlens.llm import minhash_dedup, piece_lattice, secret_scan, source_mix, toxicity
from basketlens.llm.registry import table
from basketlens.shipping import ship
from basketlens.sources.staging import materialize, remember, shared_folder

MIX_REPEATS = 1.5
SENT_IDS = 2_000_000  # (id, hash) pairs of 16 bytes that are broadcast; a longer list is joined by a shuffle

# The tokens of the last stage, and the signatures of the second, have no SQL form.
ORACLE_SQL = None


def drop_toxic(spark, docs, sf_dir):
    ship(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def _rows(docs):
    """The rows as one struct column, so that no column's name can clash with ours."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def drop_near_duplicates(spark, docs, sf_dir):
    """The row with the smallest id of each component; of equal (id, text) rows one."""
    ship(spark)
    found = materialize(minhash_dedup.near_duplicates(docs).select("doc_id", "digest", "component"))
    linked = found.where("component is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "digest"))
    winners = linked.groupBy("component").agg(first.alias("w")).select("w.doc_id", "w.digest", F.lit(True).alias("won"))
    rows = linked.groupBy("doc_id", "digest").agg(F.count("*").alias("n"))
    same = F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("r.digest") == F.col("w.digest"))
    judged = materialize(rows.alias("r").join(winners.alias("w"), same, "left")
                         .select("r.doc_id", "r.digest", "n", F.coalesce("won", F.lit(False)).alias("won")))
    all_rows = docs.select(_rows(docs), F.col("doc_id").alias("id"), F.xxhash64("text").alias("digest"))

    def listed(condition):
        keys = judged.where(condition).select(F.col("doc_id").alias("key_id"), F.col("digest").alias("key_digest"))
        n = keys.count()
        return n, F.broadcast(keys) if n <= SENT_IDS else keys

    matches = F.col("id").eqNullSafe(F.col("key_id")) & (F.col("digest") == F.col("key_digest"))
    kept = all_rows.join(listed("not won")[1], matches, "left_anti")
    # Winners that are there more than once: repeated rows, one of which stays.
    n, repeated = listed("won and n > 1")
    if n:
        once = kept.join(repeated, matches, "left_semi").dropDuplicates(["id", "digest"])
        kept = kept.join(repeated, matches, "left_anti").union(once)
    return kept.select("row.*")


def mask_secrets(spark, docs, sf_dir):
    ship(spark)
    ratios = secret_scan.learn(docs, table(spark, sf_dir, "labels"))
    parts = F.when(F.col("text").isNotNull(), secret_scan.scan_segments(F.col("text"), ratios))
    marked = docs.select(_rows(docs), parts.alias("parts")).select("row", secret_scan.masked_text(F.col("parts")).alias("masked"))
    row = F.when(F.col("masked").isNull(), F.col("row")).otherwise(
        F.col("row").withField("text", F.col("masked")).withField("n_chars", F.length("masked").cast("long")))
    return marked.select(row.alias("row")).select("row.*")


def mix_sources(spark, docs, sf_dir):
    ship(spark)
    plan = source_mix.plan_mix(docs, source_mix.COVER, target_entropy=1.0, most_repeats=MIX_REPEATS)
    return source_mix.mix(docs, plan, pass_name=None)


def to_pieces(spark, docs, sf_dir):
    ship(spark)
    encoded = piece_lattice.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("secrets", mask_secrets),
          ("source_mix", mix_sources), ("pieces", to_pieces)]


def run(spark, sf_dir):
    """All stages over the documents; the tables between them lie in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = remember(spark, f"{shared_folder(spark)}/corpus/{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
