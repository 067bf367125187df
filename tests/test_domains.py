"""Registered domains by a table of public suffixes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from crawlflow.operators import domains, flow

LINES = [
    "// a comment", "", "  ", "com", "COM // again", "pl", "com.pl", "uk", "*.uk", "!city.uk", "jp", "*.kobe.jp", "!city.kobe.jp", "b.c.deep",
]
CASES = {
    "http://www.a.b.com/x": "b.com",
    "http://a.b.com.pl/": "b.com.pl",
    "http://com.pl/": "com.pl",
    "http://x.y.z.uk:80/": "y.z.uk",
    "http://z.uk/": "z.uk",
    "http://www.city.uk/": "city.uk",
    "http://a.b.c.kobe.jp": "b.c.kobe.jp",
    "http://www.city.kobe.jp": "city.kobe.jp",
    "http://x.kobe.jp./": "x.kobe.jp",
    "http://q.a.b.c.deep/": "a.b.c.deep",
    "http://q.b.deep/": "b.deep",
    "http://unknown.tld.zz": "tld.zz",
    "http://10.1.2.3:8080/": "10.1.2.3",
    "http://[2001:db8::1]:80/": "[2001:db8::1]",
    "http://localhost": "localhost",
    "no url": "",
    None: None,
}


@pytest.fixture(scope="module")
def suffixes(spark):
    return domains.parse_suffixes(spark.createDataFrame([(x,) for x in LINES], "value string"))


def test_suffix_lines(suffixes):
    got = [tuple(r) for r in suffixes.collect()]
    assert len(got) == len(set(got)) == 10
    assert {("com", "normal"), ("uk", "wildcard"), ("uk", "normal"), ("city.uk", "exception"), ("b.c.deep", "normal")} <= set(got)


def test_longest_suffix(spark, suffixes):
    urls = spark.createDataFrame([(u, k, "x") for k, u in enumerate(CASES)] * 2, "url string, _n int, suffix string")
    got = domains.with_registered_domain(urls, suffixes)
    assert got.columns == ["url", "_n", "suffix", "domain"]
    found = got.collect()
    assert len(found) == 2 * len(CASES)
    assert {r.url: r.domain for r in found} == CASES


def test_without_suffixes_or_urls(spark, suffixes):
    urls = spark.createDataFrame([("http://www.a.b.com.pl/x",)], "url string")
    assert domains.with_registered_domain(urls, suffixes.limit(0)).first().domain == "com.pl"
    assert domains.with_registered_domain(urls.limit(0), suffixes).collect() == []


def test_the_flow_delays_by_suffix(spark, suffixes):
    """Two sites below one public suffix do not wait for each other."""
    date = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    urls = [(f"http://{h}/",) for h in ("a.one.com.pl", "b.one.com.pl", "two.com.pl")]
    judged = spark.createDataFrame(urls, "url string").select("url", date.alias("date"), F.lit("seed").alias("origin"), F.lit(1).alias("attempt"), F.lit(None).cast("string").alias("reason"))
    first = 1_704_067_200_000
    got = {r.url: (r.domain, r.release_ms - first) for r in flow.plan(judged, None, None, 1000, suffixes).collect()}
    assert got == {"http://a.one.com.pl/": ("one.com.pl", 0), "http://b.one.com.pl/": ("one.com.pl", 1000), "http://two.com.pl/": ("two.com.pl", 0)}
