import glob
import os
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from crawlflow import schemas
from crawlflow.operators import crawl, politeness
from crawlflow.operators.politeness import throttle_plan
from crawlflow.plans import inputs as I
from crawlflow.sources import seeds, sinks
from crawlflow.streaming.articles import read_folder, stream_articles, stream_rewrites
from crawlflow.streaming.feed import blocks_of, index_seeds, stream_feed
from crawlflow.streaming.throttle import stream_throttle

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    """Three files in three micro-batches give the rows of the batch function."""
    pages = I.table(spark, SF, "pages")
    pages.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = read_folder(spark, f"{tmp_path}/in", schemas.PAGES, files_per_batch=1)
    stream_articles(I.crawled(stream), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    got = spark.read.schema(schemas.ARTICLE_TOKENS).parquet(f"{tmp_path}/out")
    want = crawl.article_tokens(I.crawled(pages))
    assert got.count() == want.count() == 50
    assert got.exceptAll(want).count() == 0


def ordered_files(events, path, n):
    """Events in time order, one file per stretch of time; files are read in that order."""
    ends = [r[0] for r in events.selectExpr(f"explode(percentile(event_id, array({', '.join(str(i / n) for i in range(1, n))})))").collect()]
    for i, (low, high) in enumerate(zip([-1.0, *ends], [*ends, 1e18])):
        part = events.where((F.col("event_id") > low) & (F.col("event_id") <= high))
        part.coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):
            if name.endswith(".parquet"):
                full = os.path.join(path, name)
                if os.path.getmtime(full) > 10**9 + n:
                    os.utime(full, (10**9 + i, 10**9 + i))


def test_throttle_over_micro_batches(spark, tmp_path):
    events = I.table(spark, SF, "events")
    ordered_files(events, f"{tmp_path}/in", 4)
    delay = 4 * 3_600_000
    want = politeness.throttle_plan(events, "user_id", "ts", "event_id", delay)
    stream = read_folder(spark, f"{tmp_path}/in", events.schema, files_per_batch=1)
    for late_ms in (None, 3_600_000):
        out = f"{tmp_path}/out-{late_ms}"
        run = stream_throttle(
            stream, f"{out}/rows", f"{out}/state", f"{out}/c", "user_id", "ts", "event_id", delay, late_ms
        )
        run.awaitTermination()
        got = spark.read.parquet(f"{out}/rows")
        assert sorted(os.listdir(f"{out}/rows")) == [f"batch={i}" for i in range(4)]
        assert got.select(want.columns).exceptAll(want).count() == 0
        assert got.count() == 1000
        # Two lists are left, and no more than two versions of a part.
        assert sorted(n for n in os.listdir(f"{out}/state") if n.startswith("list=")) == ["list=2", "list=3"]
        held = Counter(os.path.basename(d) for d in glob.glob(f"{out}/state/version=*/part=*"))
        assert held and max(held.values()) <= 2


def test_untouched_parts_are_not_written(spark, tmp_path):
    """Five micro-batches, each of a domain of its own but the last, which comes back to the first."""
    schema = "id long, domain string, ts timestamp"
    for k, name in enumerate(["a", "b", "c", "d", "a"]):
        rows = [(10 * k + i, name, datetime(2024, 1, 1, 0, 0, k)) for i in range(3)] + [(10 * k + 9, None, datetime(2024, 1, 1, 0, 0, k))]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = read_folder(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, files_per_batch=1)
    stream_throttle(stream, f"{tmp_path}/rows", f"{tmp_path}/state", f"{tmp_path}/c", "domain", "ts", "id", 60_000).awaitTermination()
    want = throttle_plan(spark.read.parquet(f"{tmp_path}/in"), "domain", "ts", "id", 60_000)
    got = spark.read.parquet(f"{tmp_path}/rows").select(want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 20
    newest = {r.part: r.version for r in spark.read.parquet(f"{tmp_path}/state/list=4").collect()}
    assert sorted(newest.values()) == [1, 2, 3, 4, 4]  # b, c, d as they were; a and rows without domain anew
    # The list before still names the first version of a's part; all others of that version are gone.
    left = {v: len(glob.glob(f"{tmp_path}/state/version={v}/part=*")) for v in range(5)}
    assert left == {0: 1, 1: 1, 2: 1, 3: 2, 4: 2}


def test_rules_are_read_again(spark, tmp_path):
    urls = spark.createDataFrame([("http://a/index.html",)], "url string")
    urls.write.parquet(f"{tmp_path}/in")
    rules = f"{tmp_path}/rules"

    def run(rule):
        spark.createDataFrame([rule], "pos int, alpha string, beta string").write.mode("overwrite").parquet(rules)
        stream = read_folder(spark, f"{tmp_path}/in", schemas.URLS)
        stream_rewrites(stream, rules, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()

    run((0, "index.html", ""))
    urls.write.mode("append").parquet(f"{tmp_path}/in")
    run((0, "index", "main"))
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((r.batch, r.canonical_url) for r in got) == [(0, "http://a/"), (1, "http://a/main.html")]


def test_size_lines(spark):
    lines = {
        "http://a.com/,10": ("http://a.com/", 10),
        "http://a.com/": None,
        "http://a.com/, 10": None,
        "http://a.com/,+5": ("http://a.com/", 5),
        "http://a.com/,-5": None,
        "http://a.com/,0": None,
        "http://a.com/,2147483648": None,
        "http://a.com/,x": None,
        "http://a.com/,10,zzz": ("http://a.com/", 10),
        ",": None,
        "": None,
    }
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    got = [tuple(r) for r in seeds.parse_size_lines(frame).collect()]
    assert got == [v for v in lines.values() if v]


def test_size_log_file(spark, tmp_path):
    (tmp_path / "log").write_text("a,1\nb\nc,3\n")
    assert sorted(map(tuple, seeds.read_size_log(spark, str(tmp_path / "log")).collect())) == [("a", 1), ("c", 3)]


def test_seed_table(spark, tmp_path):
    path = f"{tmp_path}/urls"
    new = sinks.first_seeds(spark)
    new.limit(1).write.parquet(path)
    sinks.append_seeds(new, seeds.read_urls(spark, path), path)
    sinks.append_seeds(new, seeds.read_urls(spark, path), path)
    assert sorted(r.url for r in seeds.read_urls(spark, path).collect()) == list(sinks.FIRST_SEEDS)


def test_feed_stream_takes_turns(spark):
    indexed = spark.createDataFrame([(1, "a"), (2, "b")], "idx long, url string")
    stream = seeds.feed_stream(spark, indexed, 2)
    assert stream.isStreaming and stream.columns == ["url", "date"]


def test_feed_over_micro_batches(spark, tmp_path):
    """Seven seeds, five turns a micro-batch, a stop in between: as the batch feed, for any block size."""
    urls = spark.createDataFrame([(10 * k, f"u{k}") for k in range(7)], "id long, url string")
    want = sorted(tuple(r) for r in seeds.feed(urls, "id", 0, rounds=3).where("seq < 20").select("seq", "url", "date").collect())
    for block in (2, 3, 100):
        out = f"{tmp_path}/{block}"
        n = index_seeds(urls, "id", f"{out}/indexed", block)
        for batches in (3, 1):
            stream_feed(spark, f"{out}/indexed", n, f"{out}/rows", f"{out}/progress", 0, 5, batches, block=block)
        got = spark.read.parquet(f"{out}/rows").select("seq", "url", "date").collect()
        assert sorted(map(tuple, got)) == want
    assert index_seeds(urls.limit(0), "id", f"{tmp_path}/none") == 0
    stream_feed(spark, f"{tmp_path}/none", 0, f"{tmp_path}/no", f"{tmp_path}/no-progress", 0, 5)


def test_feed_reads_its_blocks_only(spark):
    blocks = spark.range(10).withColumnRenamed("id", "block")
    for first, last in ((0, 9), (25, 44), (95, 104), (103, 112), (40, 150), (0, 99), (199, 200)):
        got = {r.block for r in blocks.where(blocks_of(first, last, 100, 10)).collect()}
        assert got == {turn % 100 // 10 for turn in range(first, last + 1)}


def test_rules_sink(spark, tmp_path):
    rules = spark.createDataFrame([("x", "b"), ("a", "b"), ("q", "a")], "alpha string, beta string")
    sinks.write_rules(rules, f"{tmp_path}/rules")
    assert spark.read.parquet(f"{tmp_path}/rules").count() == 3
