"""Bloom cascades and URL rules."""

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import urls

RULES = [(k, v) for v, k in urls.RULES]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(k), v, k) for k, v in RULES if ("." + host).endswith("." + k.split("/", 1)[0]) and path.startswith("/" + k.split("/", 1)[1])]
    best = max(fits, default=None)
    return host, path, best and best[2], best[1] if best else "allow"


def test_rules(spark):
    hosts = ["example.com", "www.example.com", "a.www.example.com", "WWW.Example.COM", "example.net", "x.example.net", "net", "com", "badexample.com", "example.org", "com.org", ""]
    paths = ["", "/", "/en", "/en/", "/en/5", "/fr/1", "/es/", "/ES/", "?x=/en/", "#/en/", "/en/?q", "/a/en/", "//en/", "/en/x/y#z"]
    listed = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "mailto:x@y.com", "://com/", "a://b://com/x", "http://com\n/x", "http://com:80/x"]
    rows = [(i, u, "h", "p") for i, u in enumerate(listed)] + [(0, listed[0], "h", "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = urls.judge(pages, spark.createDataFrame(RULES + RULES[:1], "key string, verdict string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == plain(listed[r["page_id"]]), listed[r["page_id"]]


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("xxhash64(key) % 37 = 0")
    cascade = urls.build_cascade(universe.union(universe.limit(50)), listed.union(listed))
    keys = [r["key"] for r in universe.collect()]
    want = {r["key"] for r in listed.collect()}
    assert {k for k, hit in zip(keys, cascade.listed(keys), strict=True) if hit} == want
    assert len(cascade.levels) > 1 and cascade.size() < 2 * len(want)


@pytest.mark.parametrize("n", [0, 3])
def test_nothing_listed_or_asked(spark, n):
    none = spark.createDataFrame([], "key string")
    some = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    assert not urls.build_cascade(some, none).listed(["a", "b"]).any()
    assert urls.build_cascade(some, some).listed(["a", "b"]).all()
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(pages, spark.createDataFrame(RULES[:n] or [], "key string, verdict string")).collect() == []


def test_filters_are_bounded(spark):
    keys = spark.range(1_000).select(F.col("id").cast("string").alias("key"))
    with pytest.raises(MemoryError):
        urls.build_cascade(keys, keys.limit(500), most_bytes=8)


def test_judge_in_shards(spark):
    pages = [(i, f"http://a{i % 7}.h{i % 30}.example.com/d{i % 4}/e{i % 5}/x") for i in range(120)] + [(500, None), (501, "no url"), (1, "http://h1.example.com/d1/")]
    rules = [(f"h{i}.example.com/d{i % 4}/", "block" if i % 3 else "allow") for i in range(30)] + [("com/", "allow"), ("a1.h1.example.com/d1/e1/", "allow"), (None, "block")]
    frames = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "key string, verdict string")
    whole, parts = (urls.judge(*frames, **more) for more in ({}, {"most_bytes": 24}))
    assert parts.schema.names == whole.schema.names
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, whole.collect()))
