"""Per-domain delays on a stream: last releases are kept between micro-batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlflow.operators.politeness import DOMAIN_DELAY_MS, epoch_ms, throttle_plan


#: Parts into which the kept last releases are divided by a hash of the domain.
STATE_PARTS = 64


def stream_throttle(
    visits: DataFrame,
    path: str,
    state: str,
    checkpoint: str,
    domain: str,
    ts: str,
    row_id: str,
    delay_ms: int = DOMAIN_DELAY_MS,
    late_ms: int | None = None,
    parts: int = STATE_PARTS,
) -> StreamingQuery:
    """Write ``(row_id, domain, release_ms)`` of each micro-batch below ``path``.

    A micro-batch is planned like a batch, so a domain with very many visits is worked in chunks
    by many tasks; a keyed state function would see all of them in one. What is kept is one last
    release per domain, in ``parts`` parts by a hash of the domain. A micro-batch reads and writes the
    parts that its domains fall into, the others stay as they are; a list of at most ``parts`` rows
    says which version of each part holds. A repeated micro-batch starts from the list before it and
    replaces the same folders. Versions that neither this list nor the one before names are deleted, so a
    part has two at most. ``late_ms`` bounds the kept rows: a domain whose delay ended that long before
    the newest visit can no longer hold up a visit, and goes when its part is written next.
    """
    kind = dict(visits.dtypes)[domain]
    part = F.pmod(F.xxhash64(F.col(domain)), F.lit(parts)).cast("int").alias("part")

    def versions(spark: SparkSession, batch_id: int) -> dict[int, int]:
        if batch_id < 0:
            return {}
        rows = spark.read.schema("part int, version long").parquet(f"{state}/list={batch_id}").collect()
        return {r.part: r.version for r in rows}

    def plan_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = versions(spark, batch_id - 1)
        touched = {r.part for r in batch.select(part).distinct().collect()}  # at most ``parts``
        chosen: dict[int, list[int]] = {}
        for p in touched & held.keys():
            chosen.setdefault(held[p], []).append(p)
        shape = f"{domain} {kind}, release_ms long, part int"
        known = [
            spark.read.schema(shape).parquet(f"{state}/version={v}").where(F.col("part").isin(ps)).select(domain, "release_ms")
            for v, ps in chosen.items()
        ]
        before = reduce(DataFrame.unionByName, known) if known else None
        target = f"{path}/batch={batch_id}"
        plan = throttle_plan(batch, domain, ts, row_id, delay_ms, last_release=before)
        plan.write.mode("overwrite").parquet(target)
        seen = spark.read.schema(plan.schema).parquet(target).select(domain, "release_ms")
        kept = seen if before is None else seen.unionByName(before)
        kept = kept.groupBy(domain).agg(F.max("release_ms").alias("release_ms"))
        if late_ms is not None:
            newest = batch.agg(F.max(epoch_ms(batch, ts)).alias("newest"))
            kept = kept.where(F.col("release_ms") + delay_ms > newest.scalar() - late_ms)
        written = kept.withColumn("part", part).repartition("part")
        written.write.mode("overwrite").partitionBy("part").parquet(f"{state}/version={batch_id}")
        now = held | dict.fromkeys(touched, batch_id)
        spark.createDataFrame(sorted(now.items()), "part int, version long").coalesce(1).write.mode("overwrite").parquet(f"{state}/list={batch_id}")
        forget(spark, batch_id, held, now)

    def forget(spark: SparkSession, batch_id: int, held: dict[int, int], now: dict[int, int]) -> None:
        """Delete what a run of this or the next micro-batch can no longer ask for."""
        if batch_id < 2:
            return
        named = set(held.items()) | set(now.items())
        gone = {f"version={v}/part={p}" for p, v in versions(spark, batch_id - 2).items() if (p, v) not in named}
        stale = {f"version={v}" for v in {int(g.split("/")[0][8:]) for g in gone} - {v for _, v in named}}
        for name in sorted({*gone, *stale, f"list={batch_id - 2}"}):
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{name}")
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)

    return (
        visits.writeStream.foreachBatch(plan_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
