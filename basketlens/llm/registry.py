"""The queries of this subpackage and, where SQL can express them, their SQL equivalents."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a (spark, sf_dir) → DataFrame function under a name."""
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load():
    from basketlens.llm import (  # noqa: F401  (imported for their registrations)
        chat_format, piece_lattice, url_filter, minhash_dedup, toxicity, token_files, multi_index, source_mix, secret_scan,
        bloom_digest, fill_middle, hard_negatives, repeated_windows)
    return QUERIES, ORACLES
