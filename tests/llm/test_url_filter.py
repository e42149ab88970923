import random

import pytest

from basketlens.llm import url_filter as m

SCHEMA = "page_id LONG, url STRING, host STRING, row INT"


def brute(url, rules):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[1]) if fits else (host, path, None, "allow")


URLS = ["http://A.EXAMPLE.org/es/x?y", None, "nourl", "ftp://org", "x://org/", "http://b.org:80/", "http://example.org/en/123#f",
        "http://notexample.org/es/", "http://a.com/de/://x", "http://?q", "http://ÀB.com/fr/\nx", "a\nb://x.org/", "", "://", "http://com/fr/",
        "http://" + "a." * 3000 + "org/" + "p" * 100_000]


@pytest.mark.parametrize("sent", [m.SENT_RULES, 0])
def test_against_brute_force(spark, sent):
    draw = random.Random(1)
    hosts = ["org", "example.org", "www.Example.ORG", "com", "a.b.com", "net", "xcom"]
    urls = URLS + [f"http://{draw.choice(hosts)}{draw.choice(['', '/', '/es/', '/en/1', '/en/12/', '/fr/', '/de/x'])}{draw.choice(['', '?a', '#b'])}"
                   for _ in range(200)]
    rows = [(k, u, "clash", 1) for k, u in enumerate(urls)] + [(None, URLS[0], "clash", 1), (0, URLS[0], "clash", 1)]
    got = m.judge_urls(spark.createDataFrame(rows, SCHEMA).repartition(3), m.RULES, sent_rules=sent).collect()
    key = lambda x: str(x)
    assert sorted(map(tuple, got), key=key) == sorted(((i, *brute(u, m.RULES)) for i, u, *_ in rows), key=key)


def test_empty_tables_and_lists(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "x", 1)], SCHEMA)
    assert m.judge_urls(pages.limit(0), m.RULES).count() == 0
    none = spark.createDataFrame([], "verdict STRING, host STRING, path STRING")
    assert [tuple(r) for r in m.judge_urls(pages, none, default="block").collect()] == [(1, "a.org", "/", None, "block")]


def test_ties(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "x", 1)], SCHEMA)
    rules = [("allow", "org", "/"), ("block", "org", "/")]
    assert m.judge_urls(pages, rules).first()["verdict"] == "block"
