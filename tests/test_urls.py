import pytest
from pyspark.sql import functions as F

from crawlflow.functions import url as U
from crawlflow.operators import crawl


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "u string").select(fn(F.col("u"))).first()[0]


CANONICAL = {
    "HTTP://WWW.Foo.Com:80/a/./b/../c?x=1&PHPSESSID=9&y=#f": "http://www.foo.com/a/c?x=1&y",
    "https://a.b": "https://a.b/",
    "https://a.b:443/": "https://a.b/",
    "http://a.b:443/": "http://a.b:443/",
    "http://a.b/../../x/": "http://a.b/x/",
    "http://a.b/x//y/..": "http://a.b/x/",
    "http://a.b//x": "http://a.b/x",
    "http://u@a.b:8080/%7Ebob/a b?": "http://a.b:8080/~bob/a%20b",
    " http://a.b/ ": "http://a.b/",
    "http://a.b?q=1": "http://a.b/?q=1",
    "http://a.b/x/.": "http://a.b/x/",
    "http://a.b/?b=2&a=1&b=2": "http://a.b/?b=2&a=1&b=2",
    "mailto:x@y": None,
    "http:///x": None,
    "www.google.com": None,
    "": None,
}


@pytest.mark.parametrize("url,expected", CANONICAL.items())
def test_canonical(spark, url, expected):
    assert one(spark, url, U.canonical_url) == expected
    if expected:
        assert one(spark, expected, U.canonical_url) == expected


# URL, form A, form B.
DOMAINS = [
    ("http://www.inst.eecs.berkeley.edu", "inst", "inst.eecs.berkeley"),
    ("http://www.cnn.com/index.html", "cnn", "cnn"),
    ("http://www.bbc.co.uk/", None, None),
    ("http://www.bbc.co.uk/a.html", "bbc.co.uk/a", None),
    ("https://www.x.cox.com/", "x", "x"),
    ("https://www.a.info/x.org", "a", "a.info/x"),
    ("http://www.foo.de/p.php?q=1", "foo.de/p", None),
    ("http://www.a.b.net", "a.b", "a.b"),
    ("http://cnn.com/", None, None),
    ("www.google.com", None, None),
]


@pytest.mark.parametrize("url,form_a,form_b", DOMAINS)
def test_domains(spark, url, form_a, form_b):
    assert one(spark, url, U.domain_www) == (form_a or "Domain not found")
    assert one(spark, url, U.domain_tld) == (form_b or "Domain not found")


def test_registered_domain(spark):
    cases = {
        "http://www.a.b.com/x": "b.com",
        "http://www.bbc.co.uk/": "bbc.co.uk",
        "http://co.uk/": "co.uk",
        "http://localhost/": "localhost",
    }
    for url, domain in cases.items():
        assert one(spark, url, U.registered_domain) == domain


def test_reject(spark):
    dropped = ["http://a/x.css", "http://a/x.js", "mailto:a@b", "ftp://a/"]
    kept = ["http://a/x.CSS", "http://a/x.js?v=1", "http://a/x.png", "http://a/x.pdf"]
    frame = spark.createDataFrame([(u,) for u in dropped + kept], "url string")
    assert [r.url for r in crawl.reject(frame).collect()] == kept
