"""Per-domain delays, recent-domain shares and the spread of URLs over workers.

Each operator is a window per domain by meaning. A domain may hold a third of all rows, so none
of them sorts a whole domain in one task: rows are cut into chunks inside a domain, each chunk is
worked on its own, and only one summary row per chunk meets in the domain's window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from crawlflow.operators.sequence import with_position
from crawlflow.session import materialize

# Delay between two visits of a domain, what counts as recent, and when a domain
# is over-represented (percent), and the number of workers.
DOMAIN_DELAY_MS = 1000
RECENT = 100
OVERLOAD_PERCENT = 15
WORKERS = 4

#: Span of time, and of positions, that one window group covers.
CHUNK_MS = 60_000
BLOCK = 65_536


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970; a timestamp without zone is read as UTC."""
    moment = F.col(name)
    if dict(df.dtypes)[name] == "timestamp_ntz":
        moment = F.from_utc_timestamp(moment.cast("timestamp"), F.current_timezone())
    return F.unix_millis(moment)


def _chunks(visits: DataFrame, domain: str, ts: str, row_id: str, chunk_ms: int) -> DataFrame:
    return visits.select(
        F.col(row_id), F.col(domain), epoch_ms(visits, ts).alias("_ms")
    ).withColumn("_chunk", F.expr(f"_ms div {chunk_ms}"))


def throttle_gap(
    visits: DataFrame,
    domain: str,
    ts: str,
    row_id: str,
    delay_ms: int = DOMAIN_DELAY_MS,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """``(row_id, domain, wait_ms)``: how long a visit waits for its domain's last one.

    A visit without a domain does not wait.
    """
    rows = _chunks(visits, domain, ts, row_id, chunk_ms)
    inside = W.partitionBy(domain, "_chunk").orderBy("_ms", row_id)
    between = W.partitionBy(domain).orderBy("_chunk")
    carried = (
        rows.groupBy(domain, "_chunk")
        .agg(F.max("_ms").alias("_last"))
        .select(domain, "_chunk", F.lag("_last").over(between).alias("_carried"))
    )
    last = F.coalesce("_before", "_carried")
    wait = F.when(
        F.col(domain).isNotNull(), F.greatest(F.lit(0), delay_ms - (F.col("_ms") - last))
    )
    local = rows.withColumn("_before", F.lag("_ms").over(inside))
    return (
        local.join(carried, [domain, "_chunk"], "left")
        .select(row_id, domain, F.coalesce(wait, F.lit(0)).cast("long").alias("wait_ms"))
    )


def throttle_plan(
    visits: DataFrame,
    domain: str,
    ts: str,
    row_id: str,
    delay_ms: int = DOMAIN_DELAY_MS,
    chunk_ms: int = CHUNK_MS,
    last_release: DataFrame | None = None,
) -> DataFrame:
    """``(row_id, domain, release_ms)``: when each visit may go, as every wait delays the next.

    The k-th visit of a domain leaves at ``max(ts_k, release_(k-1) + delay)``, which is
    ``k * delay + max(ts_j - j * delay)`` over the visits up to it: a running maximum.
    ``last_release(domain, release_ms)`` continues an earlier plan.
    """
    rows = _chunks(visits, domain, ts, row_id, chunk_ms)
    inside = W.partitionBy(domain, "_chunk").orderBy("_ms", row_id)
    ranked = rows.withColumn("_k", F.row_number().over(inside)).withColumn(
        "_slack", F.col("_ms") - F.col("_k") * F.lit(delay_ms).cast("long")
    )
    earlier = W.partitionBy(domain).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    # With a chunk's first rank shifted by the rows before it, its slack shifts by delay per row.
    summary = (
        ranked.groupBy(domain, "_chunk")
        .agg(F.count("*").alias("_n"), F.max("_slack").alias("_best"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) * delay_ms)
        .withColumn("_carried", F.max(F.col("_best") - F.col("_offset")).over(earlier))
    )
    if last_release is not None:
        # The earlier plan acts as a visit of rank 0 at its last release.
        start = last_release.select(domain, F.col("release_ms").alias("_start"))
        summary = summary.join(start, domain, "left").withColumn(
            "_carried", F.greatest("_carried", "_start")
        )
    running = F.max("_slack").over(inside.rowsBetween(W.unboundedPreceding, 0))
    slack = F.greatest(F.col("_running") - F.col("_offset"), F.col("_carried"))
    chunks = summary.select(domain, "_chunk", "_offset", "_carried")
    planned = F.col("_k") * F.lit(delay_ms).cast("long") + F.col("_offset") + slack
    free = F.col(domain).isNull()
    return (
        ranked.withColumn("_running", running)
        .join(chunks, [domain, "_chunk"], "left")
        .select(
            row_id, domain, F.when(free, F.col("_ms")).otherwise(planned).alias("release_ms")
        )
    )


def recent_domain_share(
    offered: DataFrame,
    recent: int = RECENT,
    overload_percent: float = OVERLOAD_PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """``(idx, domain, share, overloaded)``: a domain's percentage of the ``recent`` URLs before.

    ``offered(idx, domain)`` has a dense 1-based ``idx``. Positions are cut into blocks, and the
    last ``recent`` rows of a block are shown to the next one as well, so the window of a domain
    never spans more than one block.
    """
    placed = offered.select(
        "idx",
        "domain",
        F.explode(
            F.expr(f"sequence((idx - 1) div {block}, (idx - 1 + {recent}) div {block})")
        ).alias("_block"),
    )
    before = W.partitionBy("_block", "domain").orderBy("idx").rangeBetween(-recent, -1)
    present = F.least(F.col("idx") - 1, F.lit(recent))
    share = F.when(present > 0, F.col("_seen") * 100.0 / present).otherwise(F.lit(0.0))
    return (
        placed.withColumn("_seen", F.count("*").over(before))
        .where(f"_block = (idx - 1) div {block}")
        .select("idx", "domain", share.alias("share"))
        .withColumn("overloaded", F.col("share") > overload_percent)
    )


def recent_urls(offered: DataFrame, recent: int = RECENT) -> DataFrame:
    """``(idx, url)``: the latest URLs, newest first. The bound is what the list means."""
    return offered.select("idx", "url").orderBy(F.desc("idx")).limit(recent)


def spread_workers(
    offered: DataFrame, workers: int = WORKERS, last: DataFrame | None = None, defer_overloaded: bool = False
) -> DataFrame:
    """``(idx, url, domain, worker, turn, reason)``: who visits a URL and as which of its visits, from 0 on.

    No worker visits a domain twice in a row. URLs are dealt round the workers, the most frequent domain
    first, so each worker has its fair part of every domain. Of the domain that fills more than half of a
    worker's turns, what cannot be kept apart is deferred: ``worker`` and ``turn`` are null and ``reason`` is
    ``no_worker``; nothing else is. With ``defer_overloaded``, URLs whose domain holds too much of the
    recent ones are deferred before that, as ``overloaded``. A worker takes its URLs, in the order they
    are dealt, in every other turn and then in the turns between.

    ``last(worker, domain)`` hands on where each worker was last, so that rounds can follow each other
    (``last_visits``); a worker that would begin there takes its turns from the end.

    The only sort over all rows is by (domain size, domain, ``idx``) and splits a hot domain; what meets in
    one place is a row per worker. A null domain counts as the domain without name.
    """
    named = offered.select("idx", "url", F.coalesce("domain", F.lit("")).alias("domain"))
    over = None
    if defer_overloaded:
        share = recent_domain_share(named).select("idx", "overloaded")
        judged = materialize(named.join(share, "idx"), "offered")
        named, over = judged.where("not overloaded").drop("overloaded"), judged.where("overloaded").drop("overloaded")
    counted = named.join(named.groupBy("domain").agg((-F.count("*")).alias("_rank")), "domain")
    dealt = with_position(counted, "_rank", "domain", "idx").withColumn("worker", (F.col("pos") % workers).cast("int"))
    dealt = dealt.withColumn("_q", F.expr(f"pos div {workers}"))
    # A worker's own most frequent domain goes to its front; its parts differ from fair ones by one at most.
    parts = dealt.groupBy("worker", "domain").agg(F.count("*").alias("_first"), F.min("_q").alias("_start"))
    top = F.max_by(F.struct("domain", "_first", "_start"), F.struct("_first", -F.col("_start")))
    sums = parts.groupBy("worker").agg(F.sum("_first").alias("_n"), top.alias("_t"))
    sums = sums.select("worker", "_n", F.col("_t.domain").alias("_top"), "_t._first", "_t._start")
    if last is not None:
        here = last.select("worker", F.coalesce("domain", F.lit("")).alias("_last"))
        sums = sums.join(here, "worker", "left")
    else:
        sums = sums.withColumn("_last", F.lit(None).cast("string"))
    back = F.coalesce(F.col("_last") == F.col("_top"), F.lit(False))
    room = F.col("_n") - F.col("_first") + F.when(back, 0).otherwise(1)
    plan = sums.select("worker", back.alias("_back"), F.least("_first", room).alias("_kept"), (F.col("_first") - F.least("_first", room)).alias("_cut"), "_n", "_first", "_start", "_top")
    rows = dealt.join(F.broadcast(plan), "worker")  # a row per worker
    moved = F.when(F.col("domain") == F.col("_top"), F.col("_q") - F.col("_start"))
    rows = rows.withColumn("_q", moved.when(F.col("_q") < F.col("_start"), F.col("_q") + F.col("_first")).otherwise(F.col("_q")))
    deferred = (F.col("_q") >= F.col("_kept")) & (F.col("_q") < F.col("_first"))
    at = F.when(F.col("_q") < F.col("_kept"), F.col("_q")).otherwise(F.col("_q") - F.col("_cut"))
    n = F.col("_n") - F.col("_cut")
    half = F.floor((n + 1) / 2)
    turn = F.when(at < half, 2 * at).otherwise(2 * (at - half) + 1)
    turn = F.when(F.col("_back"), n - 1 - turn).otherwise(turn).cast("long")
    placed = rows.select(
        "idx", "url", "domain", F.when(~deferred, F.col("worker")).alias("worker"), F.when(~deferred, turn).alias("turn"),
        F.when(deferred, "no_worker").alias("reason"),
    )
    if over is None:
        return placed
    nowhere = F.lit(None).cast("int").alias("worker"), F.lit(None).cast("long").alias("turn")
    return placed.unionByName(over.select("idx", "url", "domain", *nowhere, F.lit("overloaded").alias("reason")))


def last_visits(spread: DataFrame) -> DataFrame:
    """``(worker, domain)`` of each worker's last turn."""
    return spread.where("worker is not null").groupBy("worker").agg(F.max_by("domain", "turn").alias("domain"))
