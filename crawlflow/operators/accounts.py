"""Row accounting: where every row of the crawl log, and every URL it sends back, has gone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from crawlflow.functions import html as H, url as U
from crawlflow.operators import crawl
from crawlflow.session import materialize

#: What a fetch result may send back, by the origin it has in the frontier.
SENT_BACK = ("redirect", "retry", "outlink")


def _entry(kind: str, outcome: Column | str, n: Column) -> Column:
    outcome = F.lit(outcome) if isinstance(outcome, str) else outcome
    return F.struct(F.lit(kind).alias("kind"), outcome.alias("outcome"), n.cast("long").alias("n"))


def _fates(kind: str, canonical: Column) -> list[Column]:
    """How many of an array of canonical URLs are admitted, rejected, invalid, or repeat an earlier one of the row."""
    valid = F.array_compact(canonical)
    admitted = F.filter(valid, lambda u: ~U.is_rejected(u))
    distinct = F.size(F.array_distinct(admitted))
    return [
        _entry(kind, "admitted", distinct),
        _entry(kind, "repeated", F.size(admitted) - distinct),
        _entry(kind, "rejected", F.size(valid) - F.size(admitted)),
        _entry(kind, "invalid", F.size(canonical) - F.size(valid)),
    ]


def ledger(fetch_log: DataFrame, max_attempts: int | None = None, entered: Observation | None = None) -> DataFrame:
    """``(kind, outcome, n)``, counted from one scan of the log.

    ``result`` has one outcome a row: the reason for which it is reported, ``content``, or ``sent_on`` for a
    move or retry that is not reported. ``no_status`` counts rows without a status, which are like those
    of any other. Each kind of ``SENT_BACK`` has an outcome for each URL. ``entered`` observes how many rows and
    URLs went in, before any outcome is decided.
    """
    moved = F.coalesce(F.col("status").isin(*crawl.MOVED), F.lit(False))
    retry = F.coalesce(F.col("status").isin(*crawl.RETRY), F.lit(False))
    if max_attempts is not None:
        retry = retry & F.coalesce(F.col("attempt") < max_attempts, F.lit(False))
    content = F.coalesce(crawl.has_content(), F.lit(False)) & ~moved
    none = F.array().cast("array<string>")
    rows = H.with_resolved_links(fetch_log).select(
        "status", content.alias("_content"),
        crawl.drop_reason(max_attempts).alias("_reason"),
        F.when(moved & F.col("moved_to").isNotNull(), F.array(crawl.moved_target())).otherwise(none).alias("_redirect"),
        F.when(retry, F.array("url")).otherwise(none).alias("_retry"),
        F.when(content, F.col("resolved")).otherwise(none).alias("_outlink"),
    )
    if entered is not None:
        sizes = [F.sum(F.size(f"_{kind}")).alias(kind) for kind in SENT_BACK]
        rows = rows.observe(entered, F.count(F.lit(1)).alias("result"), *sizes)
    for kind in SENT_BACK:
        rows = rows.withColumn(f"_{kind}", U.canonical_urls(F.col(f"_{kind}")))
    outcome = F.coalesce("_reason", F.when(F.col("_content"), "content").otherwise("sent_on"))
    entries = [
        _entry("result", outcome, F.lit(1)),
        _entry("status", F.when(F.col("status").isNull(), "no_status").otherwise("given"), F.lit(1)),
        *(entry for kind in SENT_BACK for entry in _fates(kind, F.col(f"_{kind}"))),
    ]
    counted = rows.select(F.inline(F.filter(F.array(*entries), lambda e: e["n"] > 0)))
    return counted.groupBy("kind", "outcome").agg(F.sum("n").alias("n"))


def accounts(fetch_log: DataFrame, now: Column, max_attempts: int | None = None) -> DataFrame:
    """``(kind, outcome, n, n_out)``: the ledger beside what the outputs really hold.

    ``n_out`` is the number of rows that ``quarantine`` has for a reason, that the admitted feedback has for an origin
    and that ``html_gate`` passes on and no move takes back; null where an outcome has no output. Rows that go in
    and have no outcome, or two, are an error.
    """
    entered = Observation("entered")
    book = materialize(ledger(fetch_log, max_attempts, entered), "ledger")
    # A handful of sums, one for each kind.
    booked = {row.kind: row.n for row in book.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    # An empty log may be planned away together with what observes it.
    went_in = {kind: n or 0 for kind, n in entered.get.items()} if booked else {"result": fetch_log.count()}
    if any(booked.get(kind, 0) != n for kind, n in went_in.items()):
        raise RuntimeError(f"rows without exactly one outcome: {went_in} went in, {booked} are booked")
    moved = F.coalesce(F.col("status").isin(*crawl.MOVED), F.lit(False))
    passed = crawl.html_gate(fetch_log).where(~moved).where(crawl.drop_reason(max_attempts).isNull())
    back = crawl.admit(crawl.feedback(fetch_log, now, max_attempts))
    outputs = (
        crawl.quarantine(fetch_log, max_attempts).select(F.lit("result").alias("kind"), F.col("reason").alias("outcome"))
        .unionByName(passed.select(F.lit("result").alias("kind"), F.lit("content").alias("outcome")))
        .unionByName(back.select(F.col("origin").alias("kind"), F.lit("admitted").alias("outcome")))
        .groupBy("kind", "outcome").agg(F.count("*").alias("n_out"))
    )
    return book.join(outputs, ["kind", "outcome"], "full").select("kind", "outcome", F.coalesce("n", F.lit(0)).alias("n"), "n_out")
