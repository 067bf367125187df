"""The whole flow as a stream that is its own source: a micro-batch is a step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from crawlflow import schemas
from crawlflow.operators.flow import run_step, seeded


def stream_flow(
    seeds: DataFrame, web: DataFrame, rules: DataFrame, now: Column, out: str, checkpoint: str, steps: int = 3, **options: object
) -> None:
    """Run up to ``steps`` micro-batches over the files of ``out``/inbox, where seeds are put and to which every micro-batch adds.

    The folder's files are a streaming source, so each is read in one micro-batch, whatever happens
    between runs. ``web`` and ``rules`` are static sides of stream-static joins, read anew by each
    micro-batch. All sinks of a micro-batch are written from its one log; a micro-batch that runs again
    replaces its folders. The flow ends early when nothing is sent back any more.
    """
    spark = seeds.sparkSession
    seeded(seeds).write.mode("overwrite").parquet(f"{out}/inbox/step=0")
    for _ in range(steps):
        arrived = (
            spark.readStream.schema(schemas.FRONTIER).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", 1_000_000).parquet(f"{out}/inbox")
        )
        run = (
            arrived.writeStream.foreachBatch(lambda batch, step: run_step(batch, step, out, web, rules, now, **options))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
