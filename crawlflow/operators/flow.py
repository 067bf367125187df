"""The whole flow, step by step: URLs are admitted and planned, fetch results routed, and what they send
back is the next step's input.

A step takes ``(url, date, origin, attempt)`` rows and writes, each below ``out`` in its own ``step=k`` folder:

* ``planned``: canonical URLs that are neither invalid, rejected, denied by robots rules nor planned before
  with the same attempt, with the time at which their domain's delay lets them go,
* ``log``: those with their fetch results, the one table that the other outputs read,
* ``articles``: text and tokens of fetched pages,
* ``dropped``: every row that leaves the flow, with the reason,
* ``inbox`` of step k + 1: moves, retries and out-links.

Folders are replaced as a whole, so a step that runs again gives the same tables. A stream's
micro-batches and a loop over steps run the same function (``run_step``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crawlflow import schemas
from crawlflow.functions import url as U
from crawlflow.operators import crawl, robots
from crawlflow.operators.domains import with_registered_domain
from crawlflow.operators.politeness import DOMAIN_DELAY_MS, throttle_plan

PLANNED = "url string, attempt int, date timestamp, origin string, domain string, release_ms long"
DROPPED = "url string, reason string"
STATE = "domain string, release_ms long"


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(given, url, date, origin, attempt, reason)``: the canonical URL, and why it is not admitted, if so."""
    named = F.transform(U.canonical_urls(F.array("url")), lambda u: F.struct(F.col("url").alias("given"), u.alias("url"), *map(F.col, ("date", "origin", "attempt"))))
    known = robots.with_denied(urls.select(F.inline(named)), rules)
    reason = (
        F.when(F.col("url").isNull(), "invalid_url").when(U.is_rejected(F.col("url")), "rejected").when(F.col("denied"), "robots_denied")
    )
    return known.withColumn("reason", reason).drop("denied")


def plan(
    judged: DataFrame, before: DataFrame | None, last_release: DataFrame | None, delay_ms: int, suffixes: DataFrame | None = None
) -> DataFrame:
    """Admitted rows, one for each URL and attempt that was not planned ``before``, with release times by registered domain.

    ``suffixes`` is the table of public suffixes; without it the built-in list of two-label suffixes serves.
    """
    key = ["url", "attempt"]
    new = judged.where("reason is null").groupBy(*key).agg(F.min(F.struct("date", "origin")).alias("first")).select(*key, "first.*")
    if before is not None:
        new = new.join(before.select(*key), key, "left_anti")
    named = new.withColumn("domain", U.registered_domain(F.col("url"))) if suffixes is None else with_registered_domain(new, suffixes)
    named = named.withColumn("visit", F.concat_ws("#", "url", "attempt"))
    times = throttle_plan(named, "domain", "date", "visit", delay_ms, last_release=last_release)
    return named.join(times.select("visit", "release_ms"), "visit").select(*key, "date", "origin", "domain", "release_ms")


def run_step(
    urls: DataFrame, step: int, out: str, web: DataFrame, rules: DataFrame, now: Column,
    max_attempts: int = 3, delay_ms: int = DOMAIN_DELAY_MS, suffixes: DataFrame | None = None,
) -> None:
    """One step over ``urls``; ``web`` (canonical ``url``, ``status, moved_to, fetched_url, html``) has fetch results."""
    spark = urls.sparkSession

    def put(rows: DataFrame, name: str, at: int = step) -> DataFrame:
        path = f"{out}/{name}/step={at}"
        rows.write.mode("overwrite").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    judged = put(judge(urls, rules), "judged")
    before = last = None
    if step > 0:
        before = spark.read.schema(f"{PLANNED}, step int").parquet(f"{out}/planned").where(F.col("step") < step)
        last = spark.read.schema(STATE).parquet(f"{out}/state/step={step - 1}")
    planned = put(plan(judged, before, last, delay_ms, suffixes), "planned")
    state = planned.select("domain", "release_ms")
    put((state if last is None else state.unionByName(last)).groupBy("domain").agg(F.max("release_ms").alias("release_ms")), "state")
    log = put(planned.select("url", "date", "attempt").join(web.select("url", "status", "moved_to", "fetched_url", "html"), "url", "left"), "log")
    moved = F.coalesce(F.col("status").isin(*crawl.MOVED), F.lit(False))
    put(crawl.article_tokens(log.where(~moved)), "articles")
    refused = judged.where("reason is not null").select(F.col("given").alias("url"), "reason")
    put(refused.unionByName(crawl.quarantine(log, max_attempts)), "dropped")
    put(crawl.feedback(log, now, max_attempts), "inbox", step + 1)


def crawl_steps(
    seeds: DataFrame, web: DataFrame, rules: DataFrame, now: Column, out: str, steps: int = 3, **options: object
) -> DataFrame:
    """``steps`` steps from ``seeds`` (``url, date``) on; see ``results``."""
    spark = seeds.sparkSession
    seeded(seeds).write.mode("overwrite").parquet(f"{out}/inbox/step=0")
    for step in range(steps):
        run_step(spark.read.schema(schemas.FRONTIER).parquet(f"{out}/inbox/step={step}"), step, out, web, rules, now, **options)
    return results(spark, out)


def seeded(seeds: DataFrame) -> DataFrame:
    return seeds.select("url", "date", F.lit("seed").alias("origin"), F.lit(1).alias("attempt"))


def results(spark: SparkSession, out: str) -> DataFrame:
    """``(step, sink, url, attempt, origin, release_ms, reason, tokens)``: what every step has put out."""

    def read(name: str, schema: object, sink: str, step: str = "step") -> DataFrame:
        shape = schema if isinstance(schema, str) else ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        rows = spark.read.schema(f"{shape}, step int").parquet(f"{out}/{name}")
        have = set(rows.columns)
        empty = {"attempt": "int", "origin": "string", "release_ms": "long", "reason": "string", "tokens": "array<string>"}
        return rows.select(
            F.expr(step).alias("step"), F.lit(sink).alias("sink"), "url",
            *[F.col(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in empty.items()],
        )

    return (
        read("planned", PLANNED, "planned")
        .unionByName(read("articles", schemas.ARTICLE_TOKENS, "article"))
        .unionByName(read("dropped", DROPPED, "dropped"))
        .unionByName(read("inbox", schemas.FRONTIER, "frontier", "step - 1").where("step >= 0"))
    )
