"""Registry of the runnable queries and, where SQL can express them, their SQL equivalents."""

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


def load():
    from basketlens.plans import (  # noqa: F401  (imported for their registrations)
        quality_queries, feature_queries, statistics_queries, plot_queries, segment_queries)
    return QUERIES, ORACLES
