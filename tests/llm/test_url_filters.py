from __future__ import annotations

import random

from encore.llm import url_filters
from encore.llm.queries import URL_RULES

RULES = "host string, path string, verdict string"


def by_hand(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:end], rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or h and host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


def test_all_rules_against_all_urls(spark, rows):
    rng = random.Random(4)
    labels, paths = ["a", "b", "org", "com", "x-y", "É", "A"], ["", "/", "/a", "/a/b", "/ab", "/a/b?q=/c", "#/a", "?x", "/a#b"]
    rules = {(".".join(rng.choices(labels, k=rng.randint(1, 3))).lower(), rng.choice(["", "/", "/a", "/a/", "/a/b"])): rng.choice(["allow", "block"])
             for _ in range(30)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"{rng.choice(['http', ''])}://{'.'.join(rng.choices(labels, k=rng.randint(1, 4)))}{rng.choice(paths)}" for _ in range(300)]
    urls += [None, "", "no scheme.org/", "://", "http://", "a://b://org/", "http://org", "http://ORG:80/x", "http://.org/", "http://x\ny.org/a"]
    pages = spark.createDataFrame([(i, u, 9, "r") for i, u in enumerate(urls)], "page_id long, url string, _key int, rule string")
    found = url_filters.judge(pages, spark.createDataFrame(rules, RULES), keep=["page_id", "_key", "rule"], splits=3)
    assert found.columns == ["page_id", "_key", "host", "path", "rule", "verdict"]
    assert rows(found) == sorted([(i, 9, *by_hand(u, rules)) for i, u in enumerate(urls)], key=repr)


def test_rules_of_the_query(spark):
    rules = spark.createDataFrame(URL_RULES, RULES)
    urls = ["http://www.EXAMPLE.org/es/1", "http://example.org/en/12", "http://org/en/1", "https://a.com/fr/", "https://a.com/de/x?y", "https://a.net/de/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_filters.judge(pages, rules).collect()}
    assert found == {0: ("example.org/es/", "block"), 1: ("example.org/en/1", "block"), 2: ("org/", "allow"),
                     3: ("com/fr/", "allow"), 4: ("com/de/", "block"), 5: (None, "allow")}


def test_large_ids_beside_nulls(spark):
    big = (1 << 62) + 1
    pages = spark.createDataFrame([(big, "http://a.b/"), (None, "http://a.b/")], "page_id long, url string").coalesce(1)
    assert {r.page_id for r in url_filters.judge(pages, spark.createDataFrame([], RULES), splits=1).collect()} == {big, None}


def test_ties_nulls_and_empty_tables(spark, rows):
    pages = spark.createDataFrame([(1, "http://a.b/x"), (1, "http://a.b/x"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame([("b", "/x", "allow"), ("b", "/x", "block"), (None, "/", "block"), ("b", None, "block")], RULES)
    assert rows(url_filters.judge(pages, rules)) == sorted(
        [(1, "a.b", "/x", "b/x", "block")] * 2 + [(None, "", "", None, "allow")], key=repr)
    assert {r.verdict for r in url_filters.judge(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert url_filters.judge(pages.limit(0), rules).count() == 0
