"""Inputs that Spark derives from the given tables where a table is not given.

Each has a twin in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlflow.functions import url as U
from crawlflow.operators.sequence import with_position

START_MS = 1_704_067_200_000  # 2024-01-01
PERIOD_MS = 500
NOW_MS = 1_706_745_600_000  # 2024-02-01
#: Politeness delay asked for the events table, whose keys come by the hour.
EVENT_DELAY_MS = 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def now():
    return F.expr(f"timestamp_millis({NOW_MS})")


def crawled(pages: DataFrame) -> DataFrame:
    """``(url, date, html)``: pages in the order they were fed."""
    date = F.expr(f"timestamp_millis({START_MS} + page_id * {PERIOD_MS})")
    return pages.select("url", date.alias("date"), "html")


def size_lines(pages: DataFrame) -> DataFrame:
    """A size log as text, one line in six well formed for each kind of odd line."""
    return pages.select(
        F.expr(
            """
            case page_id % 6
                when 1 then url
                when 2 then concat(url, ', ', octet_length(html))
                when 3 then concat(url, ',+', octet_length(html))
                when 4 then concat(url, ',-', octet_length(html))
                when 5 then concat(url, ',', octet_length(html), ',zzz')
                else concat(url, ',', octet_length(html), if(page_id % 12 = 6, '0000000', ''))
            end
            """
        ).alias("value")
    )


def url_variants(pages: DataFrame) -> DataFrame:
    """``(page_id, variant, url)``: each URL in several spellings."""
    spellings = F.expr(
        """
        array(
            url,
            concat(upper(regexp_extract(url, '^[a-z]+://[^/]*', 0)),
                   if(url like 'https%', ':443', ':80'), '/./x//y/../%7Ea b',
                   '?b=&PHPSESSID=', page_id, '&a=1#f'),
            concat(regexp_extract(url, '^[a-z]+://[^/]*', 0), '?q=', page_id),
            concat(replace(url, '://', '://user@'), '/../..'),
            concat('mailto:a@', regexp_extract(url, '^[a-z]+://([^/]*)', 1))
        )
        """
    )
    return pages.select("page_id", F.posexplode(spellings).alias("variant", "url"))


def url_suffixes(pages: DataFrame) -> DataFrame:
    """Each URL as it is and as several kinds of file."""
    made = F.expr(
        """
        array(url, concat(url, '.css'), concat(url, '.js?v=1'), concat(url, '.CSS'),
              concat(url, '.tgz'), concat(url, '.png'), replace(url, 'http', 'ftp'),
              concat('mailto:', page_id, '@example.com'), concat('file://', page_id, '.gz'))
        """
    )
    return pages.select(F.explode(made).alias("url"))


def domain_samples(pages: DataFrame) -> DataFrame:
    """Each URL as it is, with ``www.`` in front of its host and under other suffixes."""
    made = F.expr(
        """
        array(url, regexp_replace(url, '://', '://www.'),
              regexp_replace(url, '[.](com|org|net)/', '.co.uk/'),
              regexp_replace(url, '://(.*)[.](com|org|net)/', '://www.$1.gov/'),
              regexp_replace(url, '[.](com|org|net)/', '.info/'))
        """
    )
    return pages.select(F.explode(made).alias("url"))


def host_samples(pages: DataFrame) -> DataFrame:
    """More spellings of hosts: addresses, ports, capitals, closing dots, deeper names, none at all."""
    made = F.expr(
        """
        array(url, regexp_replace(url, '://', '://a.b.'), regexp_replace(url, '[.](com|org|net)/', '.co.uk./'),
              concat('http://10.1.2.', page_id % 250, ':8080/x'), concat('http://[2001:db8::', page_id % 10, ']:80/'),
              upper(regexp_replace(url, '[.](com|org|net)/', '.INFO:81/')), 'http://Net/', concat('page ', page_id), null)
        """
    )
    return pages.select(F.explode(made).alias("url"))


def suffix_lines(pages: DataFrame) -> DataFrame:
    """Lines of a public suffix list: the last label of every host, the fixed two-label ones, and for hosts
    below ``.net`` a wildcard with exceptions."""
    host = U.host(F.col("url"))
    net = host.endswith(".net")
    lines = F.array(
        F.concat(F.substring_index(host, ".", -1), F.lit(" // top")),
        F.when(net, F.concat(F.lit("*."), F.substring_index(host, ".", -2))),
        F.when(net & (F.col("page_id") % 7 == 0), F.concat(F.lit("!"), F.substring_index(host, ".", -3))),
        F.lit("// a comment"),
    )
    fixed = pages.sparkSession.createDataFrame([(s,) for s in U.PUBLIC_SUFFIXES], "value string")
    return pages.select(F.explode(F.array_compact(lines)).alias("value")).distinct().unionByName(fixed)


def robots_files(pages: DataFrame) -> DataFrame:
    """``(host, body)``: one robots file per host, of three kinds."""
    kind = F.min("page_id") % 3
    body = (
        F.when(
            kind == 0,
            "# hello\nUser-agent: *\nDisallow: /de/ # german\nAllow: /de/4\n\n"
            "User-agent: otherbot\nDisallow: /\n",
        )
        .when(
            kind == 1,
            "User-agent: otherbot\nDisallow: /fr/\nUSER-AGENT: MyCrawlflow/1.0\n"
            "Disallow: /en/7*\nDisallow:   /es/  \nSitemap: /map\n",
        )
        .otherwise("Disallow: /before\nUser-agent: *\nDisallow:\nallow: /en/\n")
    )
    return pages.groupBy(U.host(F.col("url")).alias("host")).agg(body.alias("body"))


def fetch_log(pages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(url, date, attempt, status, moved_to, fetched_url, html)``, results of all kinds.

    Moves lead to pages of ``known``, by default the same table.
    """
    targets = (pages if known is None else known).select(F.col("page_id").alias("_target"), F.col("url").alias("moved_to"))
    target = F.expr(
        """
        case when page_id % 10 in (1, 2) then page_id + 1
             when page_id % 10 = 3 and page_id div 10 % 3 = 1 then page_id + 1
             when page_id % 10 = 3 and page_id div 10 % 3 = 2 then page_id - 2
             else -1 - page_id end
        """
    )
    columns = """
        if(page_id % 17 = 9, concat('mailto:', page_id), url) as url
        timestamp_millis({start} + page_id * {period}) as date
        cast(page_id % 3 + 1 as int) as attempt
        case page_id % 10 when 1 then 301 when 2 then 302 when 3 then 303 when 4 then 408
            when 5 then 502 when 6 then 404 when 7 then 503 when 8 then 307 else 200 end as status
        moved_to
        if(page_id % 7 = 0, concat(url, '?s=1'), url) as fetched_url
        case when page_id % 9 = 4 then null when page_id % 11 = 5 then ''
            when page_id % 13 = 6 then concat('%PDF-1.4 ', url) else html end as html
    """.format(start=START_MS, period=PERIOD_MS)
    entries = [e.strip() for e in columns.replace("\n            ", " ").strip().splitlines()]
    return (
        pages.withColumn("_target", target)
        .join(targets, "_target", "left")
        .selectExpr(*entries)
    )


#: Links that are invalid, rejected and twice the same.
ODD_LINKS = '<a href="http:///x">x</a><a href="/a.css">a</a><a href="/p/../q">q</a><a href="/q">q</a></body>'


def odd_log(log: DataFrame) -> DataFrame:
    """A fetch log with rows without status, targets and links that are relative, invalid or rejected."""
    at = f"(unix_millis(date) - {START_MS}) div {PERIOD_MS}"
    return (
        log.withColumn("status", F.expr(f"if({at} % 30 = 20, null, status)"))
        .withColumn("moved_to", F.expr(f"case {at} % 40 when 1 then 'mailto:x' when 11 then '/moved.css' when 21 then '/moved' else moved_to end"))
        .withColumn("html", F.when(F.expr(f"{at} % 6 = 0"), F.replace("html", F.lit("</body>"), F.lit(ODD_LINKS))).otherwise(F.col("html")))
    )


def offered(pages: DataFrame) -> DataFrame:
    """``(idx, url, domain)``: URLs in arrival order with their form-A domain."""
    numbered = with_position(pages.select("page_id", "url"), "page_id", name="idx", first=1)
    return numbered.select("idx", "url", U.domain_www(F.col("url")).alias("domain"))


def rewrite_rules(spark: SparkSession) -> DataFrame:
    """A short rule list in order of application."""
    rules = [
        ("#top", ""), ("?utm_source=feed", ""), (".html", ""), ("http://", "https://"),
        ("://www.", "://"), ("://m.", "://"), ("?page=2&ref=x", ""), ("spam-farm", "cheap-pills"),
    ]
    rows = [(i, alpha, beta) for i, (alpha, beta) in enumerate(rules)]
    return spark.createDataFrame(rows, "pos int, alpha string, beta string")


def spelled(pages: DataFrame) -> DataFrame:
    """``(url, html)``: each page under its own URL and under another spelling that a site may offer."""
    other = F.expr(
        """
        case page_id % 4 when 0 then concat(url, '/index.html') when 1 then concat(url, '?sid=1')
            when 2 then concat(url, '#top') else replace(url, '/en/', '/en-us/') end
        """
    )
    return pages.select(F.explode(F.array_distinct(F.array("url", other))).alias("url"), "html")


def web(pages: DataFrame) -> DataFrame:
    """``(url, status, moved_to, fetched_url, html)``: one fetch result for each canonical URL."""
    log = fetch_log(pages).withColumn("url", F.explode(F.filter(U.canonical_urls(F.array("url")), lambda u: u.isNotNull())))
    first = F.min(F.struct("date", "status", "moved_to", "fetched_url", "html")).alias("first")
    return log.groupBy("url").agg(first).select("url", "first.*").drop("date")
