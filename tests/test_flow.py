"""The whole flow: steps by hand, stream against batch, rows that are accounted for."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from crawlflow.operators import flow
from crawlflow.streaming.flow import stream_flow

NOW = datetime(2024, 2, 1)
PAGE = "<html><body><p>" + "word " * 60 + "</p><a href='/b'>b</a> <a href='/private/x'>x</a> <a href='c.css'>c</a></body></html>"
WEB = [
    ("http://a.com/", 200, None, "http://a.com/", PAGE),
    ("http://a.com/b", 301, "http://b.org/new", "http://a.com/b", None),
    ("http://b.org/new", 200, None, "http://b.org/new", "<html>short</html>"),
    ("http://a.com/busy", 503, None, "http://a.com/busy", None),
    ("http://a.com/gone", 302, None, "http://a.com/gone", None),
    ("http://a.com/pdf", 200, None, "http://a.com/pdf", "%PDF"),
    ("http://a.com/empty", 200, None, "http://a.com/empty", ""),
    ("http://a.com/odd", None, None, None, PAGE.replace("/b", "/odd-b")),
]
SEEDS = [f"http://a.com/{x}" for x in ("", "#again", "busy", "gone", "pdf", "empty", "nowhere", "style.css", "private/1", "odd")] + ["not a url", None]


@pytest.fixture(scope="module")
def given(spark):
    web = spark.createDataFrame(WEB, "url string, status int, moved_to string, fetched_url string, html string")
    rules = spark.createDataFrame([("a.com", "disallow", "/private")], "host string, kind string, prefix string")
    seeds = spark.createDataFrame([(u, datetime(2024, 1, 1, 0, 0, 0, 1000 * k)) for k, u in enumerate(SEEDS)], "url string, date timestamp")
    return seeds, web, rules, F.lit(NOW).cast("timestamp")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_steps(spark, given, tmp_path):
    got = flow.crawl_steps(*given, f"{tmp_path}/out", steps=4)
    by = lambda sink, *columns: Counter((r["step"], *(r[c] for c in columns)) for r in got.where(F.col("sink") == sink).collect())
    planned = by("planned", "url", "attempt")
    assert max(planned.values()) == 1
    urls = {k[0]: {u.removeprefix("http://") + f" {a}" for s, u, a in planned if s == k[0]} for k in planned}
    assert urls[0] == {f"a.com/{x} 1" for x in ("", "busy", "gone", "pdf", "empty", "nowhere", "odd")}
    assert urls[1] == {"a.com/b 1", "a.com/busy 2", "a.com/odd-b 1"}
    assert urls[2] == {"b.org/new 1", "a.com/busy 3"}
    assert 3 not in urls
    dropped = by("dropped", "url", "reason")
    for step, url, reason in (
        (0, "http://a.com/style.css", "rejected"), (0, "http://a.com/private/1", "robots_denied"), (0, "not a url", "invalid_url"), (0, None, "invalid_url"),
        (0, "http://a.com/gone", "moved_without_target"), (0, "http://a.com/pdf", "not_html"), (0, "http://a.com/empty", "empty_page"),
        (0, "http://a.com/nowhere", "not_fetched"), (1, "http://a.com/private/x", "robots_denied"), (1, "http://a.com/c.css", "rejected"),
        (2, "http://a.com/busy", "retries_exhausted"),
    ):
        assert dropped[step, url, reason] >= 1, (step, url, reason)
    articles = by("article", "url")
    assert set(articles) == {(0, "http://a.com/"), (0, "http://a.com/odd"), (2, "http://b.org/new")}


def test_every_row_is_accounted_for(spark, given, tmp_path):
    """What enters a step is planned, refused, or the same URL and attempt as a planned one; what is fetched has an outcome."""
    out = f"{tmp_path}/out"
    flow.crawl_steps(*given, out, steps=3)
    read = lambda name, step: spark.read.parquet(f"{out}/{name}/step={step}")
    done = set()
    for step in range(3):
        judged, planned = read("judged", step).collect(), read("planned", step).collect()
        assert len(judged) == read("inbox", step).count()
        keys = {(r.url, r.attempt) for r in planned}
        assert len(keys) == len(planned) and not keys & done
        done |= keys
        assert {(r.url, r.attempt) for r in judged if r.reason is None} <= done
        log = read("log", step)
        assert log.count() == len(planned)
        ends = {r.url for r in read("dropped", step).collect()} | {r.url for r in read("articles", step).collect()}
        sent = read("inbox", step + 1).collect()
        back = {r.url for r in sent}
        for r in log.collect():
            assert r.url in ends or r.url in back or r.moved_to in back, r


def test_delays_go_on_between_steps(spark, given, tmp_path):
    got = flow.crawl_steps(*given, f"{tmp_path}/out", steps=3, delay_ms=10_000_000_000).where("sink = 'planned'").collect()
    times = sorted((r.release_ms, r.step) for r in got if r.url.startswith("http://a.com"))
    assert all(b[0] - a[0] >= 10_000_000_000 for a, b in zip(times, times[1:]))
    assert [s for _, s in times] == sorted(s for _, s in times)


def test_stream_is_the_batch(spark, given, tmp_path):
    want = flow.crawl_steps(*given, f"{tmp_path}/batch", steps=3)
    stream_flow(*given, f"{tmp_path}/stream", f"{tmp_path}/progress", steps=3)
    assert rows(flow.results(spark, f"{tmp_path}/stream")) == rows(want)
    assert {r.step for r in want.select("step").distinct().collect()} == {0, 1, 2}


def test_repeated_step(spark, given, tmp_path):
    """A step that runs again, as after a failure, leaves the same tables."""
    seeds, web, rules, now = given
    out = f"{tmp_path}/out"
    want = rows(flow.crawl_steps(seeds, web, rules, now, out, steps=2))
    flow.run_step(spark.read.parquet(f"{out}/inbox/step=1"), 1, out, web, rules, now)
    assert rows(flow.results(spark, out)) == want


def test_nothing_to_crawl(spark, given, tmp_path):
    seeds, web, rules, now = given
    assert flow.crawl_steps(seeds.where("false"), web, rules, now, f"{tmp_path}/out", steps=2).count() == 0
