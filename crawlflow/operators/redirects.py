"""Following redirect chains to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crawlflow.functions import url as U
from crawlflow.operators.crawl import MOVED, moved_target
from crawlflow.session import materialize


def resolve(fetch_log: DataFrame) -> DataFrame:
    """``(url, final_url, hops)`` for every moved URL; both are null when the chain is a cycle.

    URLs and targets are compared in their canonical spelling, relative targets after being resolved
    against the URL that moved. What has none, as it is no URL with a host, stays as it is spelled.

    Every round joins the jumps with themselves, which doubles the hops taken. A jump is open
    while its target has moved as well. When a round leaves as many open as the one before, the
    rest are cycles: of finite open chains, some would have closed. So chains of any length are
    followed, in about log2 of the longest chain rounds, each written once.
    """
    both = F.array("url", moved_target())
    spelled = F.transform(F.arrays_zip(both.alias("raw"), U.canonical_urls(both).alias("name")), lambda u: F.struct(u["raw"].alias("raw"), u["name"].alias("name")))
    name = lambda u: F.coalesce(u["name"], u["raw"])
    ends = F.transform(F.array(spelled), lambda u: F.struct(name(u[0]).alias("url"), name(u[1]).alias("to")))
    known = fetch_log.where(F.col("status").isin(*MOVED) & F.col("moved_to").isNotNull()).select("date", F.inline(ends))
    moves = (
        known.groupBy("url")
        .agg(F.max_by("to", F.struct("date", "to")).alias("target"))
        .select("url", "target", F.lit(1).cast("long").alias("hops"), F.lit(True).alias("open"))
    )
    jumps = materialize(moves, "jumps")
    open_before = jumps.count()
    while open_before:
        ahead = jumps.select(
            F.col("url").alias("target"),
            F.col("target").alias("_next"),
            F.col("hops").alias("_more"),
        )
        doubled = jumps.join(ahead, "target", "left").select(
            "url",
            F.coalesce("_next", "target").alias("target"),
            (F.col("hops") + F.coalesce("_more", F.lit(0))).alias("hops"),
            F.col("_next").isNotNull().alias("open"),
        )
        jumps = materialize(doubled, "jumps")
        open_now = jumps.where("open").count()
        if open_now in (0, open_before):
            break
        open_before = open_now
    return jumps.select(
        "url",
        F.when(~F.col("open"), F.col("target")).alias("final_url"),
        F.when(~F.col("open"), F.col("hops")).alias("hops"),
    )
