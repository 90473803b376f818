import re

import pytest
from pyspark.sql import functions as F

from turnweave.llm import url_filter
from turnweave.llm.queries import RULES, op8_url_filter
from turnweave.llm.url_filter import blocks_for, canonical, filter_urls, with_listed

URLS = [
    "http://Example.NET/en/x", "https://a.example.net/en", "http://notnet/", "http://x.org/fr/1", "http://x.org/frx",
    "http://example.com/de/a?x", "http://de.example.com/de/", "no scheme", "", None, "a://b://c/d", "http://h",
    "http://h?q", "http://h#f", "http://net", "http://net/", "http://Ünet.net/ü", "http://a.com/x\ny",
]


def plainly(url):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[2]) if m else ""
    path = m[3] if m else ""
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


def test_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    nothing = pages.select(canonical(F.col("url"))).where("false")
    rows = filter_urls(pages, nothing, RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [plainly(u) for u in URLS]


@pytest.mark.parametrize("most", [1, 1 << 20])
def test_listing_is_exact_however_full_the_filter(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", most)
    urls = spark.range(3000).select(F.concat(F.lit("u"), F.col("id")).alias("k")).unionAll(spark.createDataFrame([(None,)], "k string"))
    listing = spark.range(0, 4000, 7).select(F.concat(F.lit("u"), F.col("id"))).unionAll(spark.createDataFrame([(None,), ("u0",)], "k string"))
    found = with_listed(urls, listing, "k").collect()
    assert len(found) == 3001
    assert {r.k for r in found if r.listed} == {f"u{i}" for i in range(0, 3000, 7)}


def test_sizes():
    assert blocks_for(1) == 1 and blocks_for(1000) == 256 and blocks_for(10**9) == url_filter.MAX_BLOCKS


def test_canonical(spark):
    rows = spark.createDataFrame([("HTTP://www.A.com/b/?utm_source=x&k=1&ref=y#z",), ("x",), (None,)], "url string")
    assert [r[0] for r in rows.select(canonical(F.col("url"))).collect()] == ["a.com/b?k=1", None, None]


def test_odd_tables(spark):
    pages = spark.createDataFrame([(1, "http://a/b", "x", None), (1, "http://a/b", "y", None), (None, None, None, None)], "page_id long, url string, Verdict string, _key string")
    listing = spark.createDataFrame([("a/b",)], "anything string")
    found = filter_urls(pages, listing, RULES)
    assert sorted(r.verdict for r in found.collect()) == ["allow", "block", "block"]
    assert found.columns == ["page_id", "url", "_key", "host", "path", "rule", "verdict"]
    assert filter_urls(pages.where("false"), listing, RULES).count() == 0


def test_clashing_names_and_sections(spark):
    rows = [(i, u) for i, u in enumerate(["http://www.a.com/x/1", "http://m.a.com/x/2?q", "http://a.com/y", "http://b.com", None])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    for name in ("_block", "block", "bits", "mask", "at", "possible", "sought", "c0", "row", "key", "hit", "_listed"):
        pages = pages.selectExpr("*", f"'x' AS `{name}`")
    listing = spark.createDataFrame([("a.com/x",), ("a.com/x",), (None,)], "_block string")
    found = filter_urls(pages, listing, [], key=url_filter.section)
    assert found.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    assert [r.verdict for r in found.orderBy("page_id").collect()] == ["block", "block", "allow", "allow", "allow"]
    listed = with_listed(pages.withColumn("k", F.lit("a.com/x")), listing, "k")
    assert [r.listed for r in listed.collect()] == [True] * 5


def test_the_join_decides_pages_that_nothing_else_does(spark):
    """Some pages of the registered query are blocked only as they share a part of a site with a junk page."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    judged = op8_url_filter(spark, "/root/testdata/sf0.01").join(pages.select("page_id", "html"), "page_id")
    only = judged.where("rule IS NULL AND verdict = 'block' AND NOT contains(html, '$$$')").count()
    assert 0 < only < judged.count() // 2
