"""Block and allow lists for URLs, by hashed host-suffix and path-prefix expressions.

A rule is (verdict, host, path). It fits a URL whose host is the rule's host or a subdomain of it and
whose path starts with the rule's path. A URL is expanded into one expression for each number of
host labels and each path length that some rule has, so a URL with thousands of labels or a very
long path has no more expressions than the list has shapes. Expressions meet the rules in an
equi-join on the first four bytes of their SHA-256; the full digest confirms, and the longest rule
(host and path together; on ties block, then the greater text) decides.

A list of up to ``SENT_RULES`` rules (a few dozen bytes each) is broadcast. A longer one is joined by a
shuffle in which every rule is there once for each of ``SALTS`` salts and each URL takes one of them, so that a
suffix like ``org`` with a third of all URLs spreads.

Defined cases: a null URL, or one without ``://``, has an empty host and path and no rule. The host
ends at the first ``/``, ``?`` or ``#``; A-Z become lower case; a port or user name belongs to it.
Repeated rows are judged each. Unmatched URLs get the default verdict. Other columns are kept out
of the way: only the id and the URL are read. Empty tables and empty rule lists are fine.
"""

from pyspark.sql import functions as F

from basketlens.llm.registry import query, table
from basketlens.sources.staging import materialize

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
SENT_RULES = 100_000
SALTS = 64
PREFIX_HEX = 8  # four bytes


def host_of(url):
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark, rules):
    """(digest, prefix, rule, verdict, length) of a list of rules or a frame (verdict, host, path)."""
    frame = rules if hasattr(rules, "select") else spark.createDataFrame(rules, "verdict STRING, host STRING, path STRING")
    text = F.concat("host", "path")
    return (frame.where("host is not null and path is not null and verdict in ('allow', 'block')")
            .withColumn("labels", F.size(F.split("host", r"\."))).withColumn("path_length", F.length("path"))
            .select(F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("digest"), text.alias("rule"), "verdict",
                    F.length(text).alias("length"), "labels", "path_length"))


def judge_urls(pages, rules, id_column="page_id", url_column="url", default="allow", sent_rules=SENT_RULES):
    """(id, host, path, rule, verdict) for every row."""
    spark = pages.sparkSession
    rules = materialize(rule_table(spark, rules))
    # The shapes of a list are few: lengths of a text and numbers of labels.
    shapes = rules.select("labels", "path_length").distinct().collect()
    pages = materialize(pages.select(F.col(id_column).alias("id"), host_of(F.col(url_column)).alias("host"),
                                     path_of(F.col(url_column)).alias("path"),
                                     F.monotonically_increasing_id().alias("row")))
    n_labels = F.size(F.split("host", r"\."))
    options = [F.when((n_labels >= s["labels"]) & (F.length("path") >= s["path_length"]),
                      F.concat_ws("\n", F.substring_index("host", ".", -s["labels"]),
                                  F.substring("path", 1, s["path_length"]))) for s in shapes]
    if not options:
        return pages.select(F.col("id").alias(id_column), "host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit(default).alias("verdict"))
    digests = (pages.where("host <> ''").select("row", F.explode(F.array_compact(F.array(*options))).alias("expression"))
               .select("row", F.sha2("expression", 256).alias("own")).withColumn("prefix", F.substring("own", 1, PREFIX_HEX)))
    short = rules.withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)).drop("labels", "path_length")
    if rules.count() <= sent_rules:
        met = digests.join(F.broadcast(short), "prefix")
    else:
        salted = short.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = digests.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["prefix", "salt"])
    best = F.max(F.struct("length", "verdict", "rule"))
    # "block" sorts after "allow", so the struct order is the precedence.
    judged = met.where(F.col("own") == F.col("digest")).groupBy("row").agg(best.alias("best"))
    return (pages.join(judged, "row", "left")
            .select(F.col("id").alias(id_column), "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def _sql(rules):
    """The longest fitting rule by a CASE over the rules, longest first."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [(v, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for v, h, p in ordered]
    return f"""
    WITH parts AS (
      SELECT page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages)
    SELECT page_id, host, path,
      CASE {' '.join(f"WHEN {c} THEN '{r}'" for _, r, c in fits)} END AS rule,
      CASE {' '.join(f"WHEN {c} THEN '{v}'" for v, _, c in fits)} ELSE 'allow' END AS verdict
    FROM parts"""


@query("op3_url_filter", _sql(RULES))
def op3(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), RULES)
