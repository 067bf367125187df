"""Every row of the crawl log and every URL it sends back has one outcome."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from crawlflow.operators import accounts, crawl

NOW = datetime(2024, 2, 1)
PAGE = "<html><body><a href='/b'>b</a><a href='/x/../b'>b</a><a href='c.css'>c</a><a href='http:///d'>d</a></body></html>"
LOG = [
    ("http://a.com/", 1, 200, None, PAGE),
    ("http://a.com/odd", None, None, None, PAGE),
    ("http://a.com/1", 1, 301, "/new", None),
    ("http://a.com/2", 1, 302, "style.css", None),
    ("http://a.com/3", 1, 303, "mailto:x", None),
    ("http://a.com/4", 1, 301, None, PAGE),
    ("http://a.com/5", 1, 503, None, None),
    ("http://a.com/6", 3, 503, None, None),
    ("http://a.com/7.css", 1, 408, None, "<html>busy"),
    ("not a url", 1, 502, None, "<html>busy"),
    (None, 1, 200, None, PAGE),
    ("http://a.com/8", 1, 200, None, ""),
    ("http://a.com/9", 1, 404, None, "%PDF"),
    ("http://a.com/9", 1, 404, None, "%PDF"),
]


def now():
    return F.lit(NOW).cast("timestamp")


def frame(spark, rows):
    log = spark.createDataFrame(rows, "url string, attempt int, status int, moved_to string, html string")
    return log.withColumn("date", now()).withColumn("fetched_url", F.col("url"))


def test_outcomes(spark):
    got = {(r.kind, r.outcome): (r.n, r.n_out) for r in accounts.accounts(frame(spark, LOG), now(), 3).collect()}
    assert got == {
        ("result", "content"): (3, 3),
        ("result", "sent_on"): (3, None),
        ("result", "invalid_url"): (2, 2),
        ("result", "moved_without_target"): (1, 1),
        ("result", "retries_exhausted"): (1, 1),
        ("result", "not_fetched"): (1, 1),
        ("result", "empty_page"): (1, 1),
        ("result", "not_html"): (2, 2),
        ("status", "given"): (13, None),
        ("status", "no_status"): (1, None),
        ("redirect", "admitted"): (1, 1),
        ("redirect", "rejected"): (1, None),
        ("redirect", "invalid"): (1, None),
        ("retry", "admitted"): (1, 1),
        ("retry", "rejected"): (1, None),
        ("retry", "invalid"): (1, None),
        ("outlink", "admitted"): (2, 2),
        ("outlink", "repeated"): (2, None),
        ("outlink", "rejected"): (2, None),
        ("outlink", "invalid"): (6, None),  # a page without a URL has no base for its links
    }


def test_no_rows(spark):
    assert accounts.accounts(frame(spark, LOG).limit(0), now(), 3).collect() == []


def test_a_lost_row_is_an_error(spark, monkeypatch):
    """Content that nobody notices in the ledger, though it went in."""
    real = accounts.ledger
    monkeypatch.setattr(accounts, "ledger", lambda *a: real(*a).where("outcome <> 'content'"))
    with pytest.raises(RuntimeError, match="exactly one outcome"):
        accounts.accounts(frame(spark, LOG), now(), 3)


def test_outputs_hold_what_is_booked(spark):
    log = frame(spark, LOG * 5)
    booked = {(r.kind, r.outcome): r.n for r in accounts.ledger(log, 3).collect()}
    back = crawl.admit(crawl.feedback(log, now(), 3))
    for kind in accounts.SENT_BACK:
        assert back.where(F.col("origin") == kind).count() == booked[kind, "admitted"]
    reasons = {r.reason: r["count"] for r in crawl.quarantine(log, 3).groupBy("reason").count().collect()}
    assert reasons == {o: n for (k, o), n in booked.items() if k == "result" and o not in ("content", "sent_on")}
