"""The continuous flow: frontier feedback, article tokens, and rule application on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from crawlflow.operators.crawl import admit, article_tokens, feedback
from crawlflow.operators.dust_apply import apply_decreasing


def read_folder(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """A stream over the files that arrive in a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def write_folder(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is available to a folder, exactly once per input row."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def stream_articles(crawled: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """``(url, date, text, tokens)`` of every crawled page; the batch functions, no shuffle."""
    return write_folder(article_tokens(crawled), path, checkpoint)


def stream_frontier(
    fetch_log: DataFrame, now: Column, path: str, checkpoint: str, max_attempts: int | None = None
) -> StreamingQuery:
    """Append what fetch results send back to the folder the next fetches are taken from."""
    return write_folder(admit(feedback(fetch_log, now, max_attempts)), path, checkpoint)


def stream_rewrites(urls: DataFrame, rules_path: str, path: str, checkpoint: str) -> StreamingQuery:
    """Apply the rule table as it stands when each micro-batch starts.

    Only rules that decrease a URL are applied (``apply_decreasing``). A micro-batch that is run again
    replaces its own folder.
    """

    def apply_current(batch: DataFrame, batch_id: int) -> None:
        rules = batch.sparkSession.read.parquet(rules_path)
        apply_decreasing(batch, rules).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        urls.writeStream.foreachBatch(apply_current)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
