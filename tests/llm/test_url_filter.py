import random

from deskloom.llm import url_filter
from deskloom.llm.url_filter import build_cascade, judge_urls, url_keys

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("a.example.com", "/en/", "allow"), ("net", "", "block")]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for mark in "/?#":
        host = host.split(mark)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_verdicts_equal_brute_force(spark):
    urls = [
        None, "", "no scheme", "http://", "https://Example.COM/en/1?x=/en/#y", "http://a.example.com/en/", "ftp://b.a.example.com/en/x",
        "http://notexample.com/en/", "http://x.net", "http://net?q", "http://NET#f", "http://x.org/a://b", "http://com/", "http://.com/x",
        "http://" + "a." * 5000 + "com/" + "p" * 50_000,
    ]
    random.seed(3)
    urls += ["http://" + ".".join(random.choices(["a", "example", "com", "net"], k=3)) + random.choice(["/en/", "/", "", "/en"]) for _ in range(60)]
    rows = [(i if i else None, u, "clash") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, verdict string")
    rules = spark.createDataFrame([*RULES, RULES[0], (None, "/", "allow")], "host string, path string, verdict string")
    got = {r["page_id"] or 0: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, rules).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in judge_urls(pages, rules).collect()] == [(1, "a.com", "/", None, "allow")]
    assert judge_urls(pages.filter("false"), rules).count() == 0


def test_clashing_and_odd_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://B.com/")], "page_id bigint, url string")
    clash = [("a.com", "/", "block"), ("a.com", "/", "allow")]
    for listed in (clash, clash[::-1]):
        rules = spark.createDataFrame([*listed, ("B.com", "/", "block"), ("b.com", "", "maybe")], "host string, path string, verdict string")
        got = sorted((r["page_id"], r["rule"], r["verdict"]) for r in judge_urls(pages, rules, default="block").collect())
        assert got == [(1, "a.com/", "allow"), (2, None, "block")]


def test_cascade_is_exact_however_small_its_filters(spark):
    keys = [f"k{i}" for i in range(600)]
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    cascade = build_cascade(frame.limit(600).filter("cast(substr(key, 2) as int) % 3 = 0"), frame, max_bytes=64)
    assert len(cascade.levels) > 2
    assert cascade.holds(keys).tolist() == [i % 3 == 0 for i in range(600)]


def test_keys_are_label_suffixes_with_path_starts():
    assert url_keys("a.b.c", "/x/y", {3: [1], 1: [0, 9]}) == [(3, 1, "b.c/"), (1, 0, "c")]
    assert url_filter.Cascade().holds(["x"]).tolist() == [False]
