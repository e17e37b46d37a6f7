import re

import pytest

from tillmark.llm import url_rules

SCHEMA = "page_id long, url string, host string, rule string, key string, row int"
RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"), ("block", "a.b.com", ""),
    ("allow", "", "/any"), ("allow", "net", "/x"), ("block", "net", "/x"), ("block", None, "/"),
    ("allow", "example.org", "/es/ok"), ("allow", "example.org", "/es/ok"),
]
URLS = [
    "http://example.org/es/1", "https://www.EXAMPLE.org/en/12?x#y", "http://org/", "http://org",
    "http://notexample.org/es/", "http://example.organ/es/", "http://a.com/fr/", "http://com/de/x",
    "http://x.a.b.com/fr/zz", "http://b.com/", None, "", "no scheme", "://", "http://", "http:///path",
    "http://h?q=http://example.org/es/", "http://net/xy", "http://q.net/x#://", "http://z/any",
    "http://example.org/es/okay", "http://a/b.org/x", "http://Ünï.org/p", "ftp://b,a.org/", "x://y://z",
    "http://example.org/es/" + "long/" * 20000, "http://example.org\n/es/", "http://a..org/x",
    "http://.org/", "http://org./",
]


def brute(rules, urls, default="allow"):
    out = []
    for i, url in urls:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
            host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fits = [
            (len(h) + len(p), v == "block", v, h + p) for v, h, p in rules
            if h is not None and p is not None and host and path.startswith(p)
            and (h == "" or ("." + host).endswith("." + h))
        ]
        best = max(fits, default=None)
        out.append((i, host, path, best and best[3], best[2] if best else default))
    return sorted(out, key=repr)


def run(spark, rules, urls, **options):
    pages = spark.createDataFrame([(i, u, "h", "r", "k", 1) for i, u in urls], SCHEMA).repartition(3)
    frame = spark.createDataFrame(rules, "verdict string, host string, path string")
    found = url_rules.judge(pages.select("page_id", "url"), frame, **options)
    return sorted(map(tuple, found.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


@pytest.mark.parametrize("most_bytes", [32 << 20, 500])
def test_equals_brute_force(spark, most_bytes):
    urls = list(enumerate(URLS))
    assert run(spark, RULES, urls, most_bytes=most_bytes) == brute(RULES, urls)


def test_many_nested_rules(spark):
    hosts = ["d.c.b.a", "c.b.a", "b.a", "a", "x.b.a", "y.a", "bb.a", "ba"]
    paths = ["", "/", "/p", "/p/q", "/p/qr"]
    rules = [(("allow", "block")[(i + j) % 2], h, p)
             for i, h in enumerate(hosts) for j, p in enumerate(paths)]
    urls = [(k, f"http://{s}{h}{p}/z") for k, (s, h, p) in enumerate(
        (s, h, p) for s in ("", "w.", "w-") for h in hosts for p in paths)]
    assert run(spark, rules, urls, default="block") == brute(rules, urls, "block")


def test_hot_host_and_repeated_rows(spark):
    urls = [(i % 50, "http://www.example.org/es/same") for i in range(900)] + [
        (i, f"http://h{i}.com/fr/") for i in range(300)]
    assert run(spark, RULES, urls) == brute(RULES, urls)


def test_empty_tables(spark):
    urls = list(enumerate(URLS))
    assert run(spark, RULES, []) == []
    assert run(spark, [], urls) == brute([], urls)


def test_columns_with_clashing_names_stay(spark):
    pages = spark.createDataFrame([(1, "http://org/", "h", "r", "k", 2)], SCHEMA)
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    found = url_rules.judge(pages, rules)
    assert found.columns == ["page_id", "url", "key", "row", "host", "path", "rule", "verdict"]
    assert tuple(found.first()) == (1, "http://org/", "k", 2, "org", "/", "org/", "allow")


def test_paths_equal_a_plain_search():
    import random

    draw = random.Random(4)
    for _ in range(200):
        rules = [
            (draw.choice(["allow", "block"]), "h", "".join(draw.choice("/ab") for _ in range(draw.randint(0, 6))))
            for _ in range(draw.randint(0, 25))
        ]
        paths = url_rules.Paths(rules)
        for _ in range(20):
            path = "".join(draw.choice("/ab") for _ in range(draw.randint(0, 8)))
            fits = [(len(r[2]), r[0] == "block", r) for r in rules if path.startswith(r[2])]
            best = max(fits)[2] if fits else None
            assert paths.longest(path) == best


def test_time_does_not_grow_with_the_rules_of_a_host():
    import time

    def seconds(n):
        rules = [("block", "h", f"/{i:06}/x") for i in range(n)]
        paths = url_rules.Paths(rules)
        urls = [f"/{i * 7919 % n:06}/x/y" for i in range(20000)]
        start = time.process_time()
        assert all(paths.longest(u) is not None for u in urls)
        return time.process_time() - start

    few = seconds(10)
    assert seconds(100_000) < 20 * few + 0.2
