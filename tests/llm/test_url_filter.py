"""Longest match of host and path rules against trying every rule, and against SQL."""

import random
from pathlib import Path

import duckdb

from citeweave.llm import url_filter
from citeweave.llm.catalogue import OP4_SQL, RULES, op4_url_filters


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[: next((k for k, c in enumerate(path) if c in "?#"), len(path))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(rules, host, path):
    fits = [(h.count("."), len(p), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, "allow")


def test_random_urls(spark):
    r = random.Random(2)
    labels, parts = ["org", "com", "example", "a", "b"], ["es", "en", "1", "", "x%2F"]
    rules = [(r.choice(["allow", "block"]), ".".join(r.choice(labels) for _ in range(r.randint(1, 3))), "/" + "/".join(r.choice(parts) for _ in range(r.randint(0, 3)))) for _ in range(60)]
    urls = ["http://" + ".".join(r.choice(labels) for _ in range(r.randint(1, 4))) + "/" + "/".join(r.choice(parts) + r.choice(["", "2"]) for _ in range(r.randint(0, 4))) + r.choice(["", "?q=/", "#/es/"]) for _ in range(800)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    for row in url_filter.judge_urls(pages, rules).collect():
        host, path = plain_parts(row["url"])
        assert (row["host"], row["path"]) == (host, path)
        assert (row["rule"], row["verdict"]) == plain_rule(rules, host, path)


def test_awkward_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://EXAMPLE.org", "x://example.org/es/", "a://b://example.org/", "http://example.org?x=/es/", "http://user@Example.ORG/es/1", "http://É.org/", "http://example.org\n/es/", "http://.org/", "http://example.org./es/", "HTTP://x.com/fr/?://", "http://" + "a." * 20_000 + "org/"]
    pages = spark.createDataFrame([(k, u, "h", "p", "r", "v") for k, u in enumerate(urls)], "page_id bigint, url string, host string, path string, rule string, verdict string")
    made = url_filter.judge_urls(pages, RULES)
    assert sorted(made.columns) == sorted(pages.columns)
    for row in made.collect():
        host, path = plain_parts(row["url"])
        assert (row["host"], row["path"]) == (host, path)
        assert (row["rule"], row["verdict"]) == plain_rule(RULES, host, path)
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{Path(sf_dir)}/pages.parquet'")
    frame = op4_url_filters(spark, sf_dir)
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(con.sql(OP4_SQL).fetchall(), key=repr)


def test_too_many_rules(monkeypatch):
    import pytest

    monkeypatch.setattr(url_filter, "MAX_RULES", 3)
    with pytest.raises(ValueError):
        url_filter.build_trie(RULES)
