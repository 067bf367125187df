"""The timed feed as a stream: ticks take seeds in turn, over and over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crawlflow.operators.sequence import with_position
from crawlflow.sources.seeds import FEED_PERIOD_MS

INDEXED = "idx long, url string, block long"
#: Seeds in a block; a micro-batch reads the blocks its turns fall into.
BLOCK_SEEDS = 1_000_000


def index_seeds(seeds: DataFrame, id_col: str, path: str, block: int = BLOCK_SEEDS) -> int:
    """Write the seed list as blocks of consecutive turns ``idx`` (from 0 on) and give the number of seeds."""
    placed = with_position(seeds.select(id_col, "url"), id_col, name="idx")
    placed.select("idx", "url", F.expr(f"idx div {block}").alias("block")).write.partitionBy("block").parquet(path)
    return seeds.sparkSession.read.schema(INDEXED).parquet(path).count()


def blocks_of(first: int, last: int, seeds: int, block: int) -> Column:
    """Which blocks the turns from ``first`` to ``last`` of an endless feed fall into."""
    if last - first + 1 >= seeds:
        return F.lit(True)
    start, end = first % seeds // block, last % seeds // block
    at = F.col("block")
    return at.between(start, end) if first % seeds <= last % seeds else (at >= start) | (at <= end)


def stream_feed(
    spark: SparkSession, indexed: str, seeds: int, out: str, checkpoint: str, start_ms: int,
    turns: int, batches: int = 1, period_ms: int = FEED_PERIOD_MS, block: int = BLOCK_SEEDS,
) -> None:
    """Run ``batches`` more micro-batches of ``turns`` turns each; ``(seq, url, date)`` goes to ``out``/batch=k.

    Ticks are numbered over all runs, as the checkpoint keeps the last one. A tick's turn is its number
    modulo the number of seeds. A micro-batch reads the blocks its turns fall into only, and replaces its
    own folder when it runs again. Without seeds nothing is fed.
    """
    if seeds == 0:
        return

    def put(ticks: DataFrame, batch: int) -> None:
        span = ticks.agg(F.min("value").alias("first"), F.max("value").alias("last")).first()
        if span["first"] is None:
            return
        known = ticks.sparkSession.read.schema(INDEXED).parquet(indexed).where(blocks_of(span["first"], span["last"], seeds, block))
        fed = ticks.select(F.col("value").alias("seq"), (F.col("value") % seeds).alias("idx")).join(known, "idx")
        date = F.expr(f"timestamp_millis({start_ms} + seq * {period_ms})")
        fed.select("seq", "url", date.alias("date")).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    for _ in range(batches):
        ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", turns).load()
        run = ticks.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
