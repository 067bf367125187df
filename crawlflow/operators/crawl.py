"""Operators on the crawl log: filters, gates, routing, links, frontier and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crawlflow.functions import html as H, text as X, url as U
from crawlflow.session import once, small_batches

# Status codes by what follows from them.
MOVED = (301, 302, 303)
RETRY = (408, 502, 503)


def canonicalize(urls: DataFrame, url: str = "url") -> DataFrame:
    return urls.withColumn(url, U.canonical_url(F.col(url)))


def reject(urls: DataFrame, url: str = "url") -> DataFrame:
    """Drop URLs whose extension or scheme is not crawled."""
    return urls.where(~U.is_rejected(F.col(url)))


def admit(urls: DataFrame, url: str = "url") -> DataFrame:
    """Canonical URLs, without the invalid and the rejected ones.

    Done inside an array that is then exploded, so a URL is canonicalized once; a filter on a
    computed column would compute it again for each condition.
    """
    kept = F.filter(
        U.canonical_urls(F.array(url)), lambda u: u.isNotNull() & ~U.is_rejected(u)
    )
    others = [c for c in urls.columns if c != url]
    return urls.select(*others, F.explode(kept).alias(url)).select(*urls.columns)


def has_content() -> Column:
    return F.col("html").isNotNull() & (F.col("html") != "") & H.is_html(F.col("html"))


def html_gate(fetched: DataFrame) -> DataFrame:
    """Rows with fetched, non-empty HTML."""
    return fetched.where(has_content())


def route(fetch_log: DataFrame, now: Column) -> DataFrame:
    """``(url, stream, date, redirected)``: where each fetch result goes.

    A move feeds its target back, or nothing when the target is unknown. A failure that may pass
    feeds the URL back and, like any other status, goes on to content if there is any. One row
    may go to both streams; it is read once.
    """
    # A row without a status is like any other status: content if there is any.
    moved = F.coalesce(F.col("status").isin(*MOVED), F.lit(False))
    retry = F.coalesce(F.col("status").isin(*RETRY), F.lit(False))
    redirected = ~F.col("url").eqNullSafe(F.col("fetched_url"))

    def branch(condition: Column, stream: str, url: Column, date: Column) -> Column:
        row = F.struct(
            url.alias("url"),
            F.lit(stream).alias("stream"),
            date.alias("date"),
            redirected.alias("redirected"),
        )
        return F.when(condition, row)

    branches = F.array(
        branch(moved & F.col("moved_to").isNotNull(), "frontier", F.col("moved_to"), now),
        branch(retry, "frontier", F.col("url"), now),
        branch(~moved & F.col("html").isNotNull(), "content", F.col("url"), F.col("date")),
    )
    return fetch_log.select(F.inline(F.array_compact(branches)))


def out_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``(key, link)``: the distinct canonical links of each page."""
    return H.with_out_links(pages).select(key, F.explode(once("links")).alias("link"))


def moved_target(url: str = "url", target: str = "moved_to") -> Column:
    """The target of a move as an absolute URL."""
    return U.resolve_link(F.trim(target), U.link_base(F.col(url)))


def feedback(fetch_log: DataFrame, now: Column, max_attempts: int | None = None) -> DataFrame:
    """``(url, date, origin, attempt)`` that fetch results send back: moves, retries, out-links.

    The log is read once for the three kinds. A target is resolved against the URL that moved. A row
    without a status is like any other status: its links go back if there is content. ``max_attempts``
    stops retries (``quarantine`` reports them).
    """
    moved = F.coalesce(F.col("status").isin(*MOVED), F.lit(False))
    retry = F.coalesce(F.col("status").isin(*RETRY), F.lit(False))
    if max_attempts is not None:
        retry = retry & (F.col("attempt") < max_attempts)
    first = F.lit(1)

    def rows(condition: Column, urls: Column, origin: str, attempt: Column) -> Column:
        made = F.transform(
            urls,
            lambda u: F.struct(
                u.alias("url"), F.lit(origin).alias("origin"), attempt.alias("attempt")
            ),
        )
        return F.when(condition, made).otherwise(
            F.array().cast("array<struct<url:string,origin:string,attempt:int>>")
        )

    content = H.with_out_links(fetch_log.withColumn("_content", has_content() & ~moved))
    return content.select(
        F.inline(
            F.concat(
                rows(moved & F.col("moved_to").isNotNull(), F.array(moved_target()), "redirect", first),
                rows(retry, F.array("url"), "retry", (F.col("attempt") + 1).cast("int")),
                rows(F.coalesce("_content", F.lit(False)), F.col("links"), "outlink", first),
            )
        )
    ).select("url", now.alias("date"), "origin", "attempt")


def frontier(
    seeds: DataFrame, fetch_log: DataFrame, now: Column, max_attempts: int | None = None
) -> DataFrame:
    """``(url, date, origin, attempt)``: seeds and feedback, canonical and without rejected URLs."""
    seeded = seeds.select("url", "date", F.lit("seed").alias("origin"), F.lit(1).alias("attempt"))
    return admit(seeded.unionByName(feedback(fetch_log, now, max_attempts)))


def drop_reason(max_attempts: int | None = None) -> Column:
    """Why a fetch result leaves the flow, the first reason that holds; null when none does."""
    moved = F.coalesce(F.col("status").isin(*MOVED), F.lit(False))
    reason = F.when(U.canonical_url(F.col("url")).isNull(), "invalid_url").when(
        moved & F.col("moved_to").isNull(), "moved_without_target"
    )
    if max_attempts is not None:
        spent = F.col("status").isin(*RETRY) & (F.col("attempt") >= max_attempts)
        reason = reason.when(spent, "retries_exhausted")
    return (
        reason.when(~moved & F.col("html").isNull(), "not_fetched")
        .when(~moved & (F.col("html") == ""), "empty_page")
        .when(~moved & ~H.is_html(F.col("html")), "not_html")
    )


def quarantine(fetch_log: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """``(url, reason)`` of the rows that leave the flow."""
    return fetch_log.select("url", F.explode(once(F.array(drop_reason(max_attempts)))).alias("reason"))


def extract_text(crawled: DataFrame, sentences: bool = False) -> DataFrame:
    """``(url, date, text)`` of crawled pages; pages without content are dropped.

    With ``sentences`` the text is the main piece's paragraphs that hold a clause (``with_sentences``).
    """
    extract = H.with_sentences if sentences else H.with_article
    return extract(html_gate(crawled)).select("url", "date", H.article_text().alias("text"))


def article_tokens(crawled: DataFrame, sentences: bool = False) -> DataFrame:
    """``(url, date, text, tokens)``: article text with its stemmed tokens."""
    small_batches(crawled.sparkSession)
    return extract_text(crawled, sentences).withColumn("tokens", X.stems(X.tokens(F.col("text"))))
