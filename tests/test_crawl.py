from datetime import datetime

import pytest
from pyspark.sql import functions as F

from crawlflow import schemas
from crawlflow.operators import crawl, redirects, robots

FEED, NOW = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
HTML = '<html><body><a href="/x">x</a></body></html>'


def log(spark, rows):
    """Rows of (url, status, moved_to, fetched_url, html[, attempt])."""
    full = [(u, FEED, a[0] if a else 1, s, m, f, h) for u, s, m, f, h, *a in rows]
    text = spark.createDataFrame(
        full, "url string, date string, attempt int, status int, moved_to string, fetched_url string, html string"
    )
    return text.withColumn("date", F.col("date").cast("timestamp")).to(schemas.FETCH_LOG)


def now():
    return F.lit(NOW).cast("timestamp")


@pytest.mark.parametrize(
    "status,moved_to,html,streams",
    [
        (200, None, HTML, ["content"]),
        (301, "http://b/", HTML, ["frontier"]),
        (302, "http://b/", None, ["frontier"]),
        (303, None, HTML, []),
        (408, None, None, ["frontier"]),
        (502, None, HTML, ["content", "frontier"]),
        (503, None, HTML, ["content", "frontier"]),
        (307, "http://b/", HTML, ["content"]),
        (404, None, None, []),
        (500, None, HTML, ["content"]),
    ],
)
def test_route(spark, status, moved_to, html, streams):
    rows = crawl.route(log(spark, [("http://a/", status, moved_to, "http://c/", html)]), now()).collect()
    assert sorted(r.stream for r in rows) == streams
    for r in rows:
        assert r.redirected is True
        assert r.url == (moved_to if r.stream == "frontier" and moved_to else "http://a/")
        assert str(r.date) == (FEED if r.stream == "content" else NOW)


def test_frontier_and_quarantine(spark):
    rows = [
        ("http://a/", 200, None, "http://a/", HTML),
        ("http://b/", 301, "HTTP://C/", "http://b/", None),
        ("http://d/", 503, None, "http://d/", None, 1),
        ("http://e/", 503, None, "http://e/", None, 2),
        ("http://f/", 301, None, "http://f/", None),
        ("http://g/", 200, None, "http://g/", ""),
        ("http://h/", 200, None, "http://h/", "%PDF"),
        ("nonsense", 200, None, "nonsense", HTML),
    ]
    seeds = spark.createDataFrame([("http://s/x.css",), ("http://s",)], "url string").withColumn("date", now())
    got = crawl.frontier(seeds, log(spark, rows), now(), max_attempts=2).collect()
    assert sorted((r.url, r.origin, r.attempt) for r in got) == [
        ("http://a/x", "outlink", 1),
        ("http://c/", "redirect", 1),
        ("http://d/", "retry", 2),
        ("http://s/", "seed", 1),
    ]
    bad = crawl.quarantine(log(spark, rows), max_attempts=2).collect()
    assert sorted((r.url, r.reason) for r in bad) == [
        ("http://d/", "not_fetched"),
        ("http://e/", "retries_exhausted"),
        ("http://f/", "moved_without_target"),
        ("http://g/", "empty_page"),
        ("http://h/", "not_html"),
        ("nonsense", "invalid_url"),
    ]


def test_robots(spark):
    files = spark.createDataFrame(
        [
            ("a.com", "User-agent: *\r\nDisallow: /p # why\r\nAllow: /p/ok\r\nUser-agent: evil\r\nDisallow: /q"),
            ("b.com", "Disallow: /\nUser-agent: other\nUser-agent: CrawlFlow-bot\nDisallow: /x*\nDisallow:"),
        ],
        "host string, body string",
    )
    rules = robots.parse(files)
    assert sorted(tuple(r) for r in rules.collect()) == [
        ("a.com", "allow", "/p/ok"), ("a.com", "disallow", "/p"), ("b.com", "disallow", "/x"),
    ]
    allowed = ["http://a.com/p/ok/1", "http://a.com/q", "http://b.com/y?/x", "http://c.com/p"]
    denied = ["http://a.com/p/x", "http://b.com/xyz", "https://a.com/p"]
    urls = spark.createDataFrame([(u,) for u in allowed + denied], "url string")
    assert sorted(r.url for r in robots.permit(urls, rules).collect()) == sorted(allowed)


def test_redirect_chains(spark):
    rows = [(f"u{i}", 301, f"u{i + 1}", "", None) for i in range(37)]  # ends at u37, not moved
    rows += [("c0", 302, "c1", "", None), ("c1", 302, "c2", "", None), ("c2", 303, "c1", "", None)]
    rows += [("self", 301, "self", "", None), ("one", 301, "end", "", None), ("lost", 301, None, "", None)]
    rows += [(f"hot{i}", 301, "u0", "", None) for i in range(20)] + [("u37", 200, None, "u37", HTML)]
    got = {r.url: (r.final_url, r.hops) for r in redirects.resolve(log(spark, rows)).collect()}
    want = {f"u{i}": ("u37", 37 - i) for i in range(37)}
    want.update({f"hot{i}": ("u37", 38) for i in range(20)})
    want.update({"c0": (None, None), "c1": (None, None), "c2": (None, None), "self": (None, None)})
    want["one"] = ("end", 1)
    assert got == want


def test_no_redirects(spark):
    assert redirects.resolve(log(spark, [("a", 200, None, "a", HTML)])).count() == 0


def test_row_without_status_is_routed_or_named(spark):
    schema = "url string, date timestamp, status int, moved_to string, fetched_url string, html string"
    log = spark.createDataFrame([("http://a/", None, None, None, "http://a/", "<html></html>"), ("http://b/", None, None, None, None, None)], schema)
    now = F.current_timestamp()
    assert [(r.url, r.stream) for r in crawl.route(log, now).collect()] == [("http://a/", "content")]
    assert [(r.url, r.reason) for r in crawl.quarantine(log).collect()] == [("http://b/", "not_fetched")]


def test_targets_are_resolved_and_canonical(spark):
    """Relative targets, other spellings, a chain through both, a target that is no URL, a row that is none."""
    rows = [
        ("http://A.com/a/x?b=2#f", 301, "../y"), ("http://a.com/y", 302, "//b.org"), ("http://b.org/", 303, "/end"), ("http://c.com", 301, "mailto:me@c.com"),
        ("nothing", 301, "http://a.com/y"), ("http://d.com/1", 301, "2"), ("http://d.com/2#x", 301, "http://d.com:80/1"), ("http://e.com/", 200, None),
    ]
    log = spark.createDataFrame([(u, datetime(2024, 1, 1), s, t) for u, s, t in rows], "url string, date timestamp, status int, moved_to string")
    got = {r.url: (r.final_url, r.hops) for r in redirects.resolve(log).collect()}
    assert got == {
        "http://a.com/a/x?b=2": ("http://b.org/end", 3), "http://a.com/y": ("http://b.org/end", 2), "http://b.org/": ("http://b.org/end", 1),
        "nothing": ("http://b.org/end", 3), "http://c.com/": ("mailto:me@c.com", 1), "http://d.com/1": (None, None), "http://d.com/2": (None, None),
    }
