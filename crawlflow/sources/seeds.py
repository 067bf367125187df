"""Sources: seed URLs, the timed feed and the page-size log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlflow import schemas
from crawlflow.operators.sequence import with_position

#: Time between two fed URLs.
FEED_PERIOD_MS = 500


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """The seed table; only the ``url`` column is read."""
    return spark.read.schema(schemas.URLS).parquet(path)


def seed_scan(urls: DataFrame) -> DataFrame:
    return urls.select("url")


def feed(
    seeds: DataFrame,
    id_col: str,
    start_ms: int,
    rounds: int = 1,
    period_ms: int = FEED_PERIOD_MS,
) -> DataFrame:
    """``(seq, url, date)``: the seed list, cycled ``rounds`` times, one URL per period.

    ``seq`` counts over all rounds. The number of seeds comes from a scalar subquery.
    """
    numbered = with_position(seeds.select(id_col, "url"), id_col)
    total = numbered.agg(F.count("*").alias("n"))
    return (
        numbered.withColumn("_total", total.scalar())
        .withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
        .select(F.expr("_round * _total + pos").alias("seq"), "url")
        .withColumn("date", F.expr(f"timestamp_millis({start_ms} + seq * {period_ms})"))
    )


def feed_stream(
    spark: SparkSession, indexed_seeds: DataFrame, seeds: int, rows_per_second: int = 2
) -> DataFrame:
    """The endless feed: tick ``value`` takes the seed with ``idx = value % seeds + 1``."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return (
        ticks.withColumn("idx", F.col("value") % seeds + 1)
        .join(indexed_seeds.select("idx", "url"), "idx")
        .select("url", F.col("timestamp").alias("date"))
    )


def parse_size_lines(lines: DataFrame) -> DataFrame:
    """``(url, size)`` of ``url,size`` text lines.

    The size is the second field, a whole number with an optional sign and no blanks. A line
    without a positive size is no page and is left out; further fields are ignored.
    """
    fields = F.split("value", ",")
    number = F.get(fields, F.lit(1))
    size = F.when(number.rlike("^[+-]?[0-9]+$"), number.try_cast("int"))
    return lines.select(F.get(fields, F.lit(0)).alias("url"), size.alias("size")).where("size > 0")


def read_size_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_size_lines(spark.read.text(path))


def page_sizes(pages: DataFrame) -> DataFrame:
    """``(url, size)`` in bytes, from the stored pages."""
    return pages.select("url", F.octet_length("html").alias("size"))


def in_time_order(rows: DataFrame, ts: str, folder: str, files: int) -> None:
    """Write a table as ``files`` files of equal spans of time, one after the other, for a stream to replay.

    Rows without a time come first.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    span = rows.agg(F.struct(F.min(at).alias("first"), F.max(at).alias("last")).alias("span")).scalar()
    which = F.floor((F.col("_at") - F.col("_span.first")) * files / (F.col("_span.last") - F.col("_span.first") + 1))
    placed = rows.withColumn("_at", at).withColumn("_span", span).withColumn("_file", F.coalesce(which, F.lit(0)))
    for k in range(files):
        placed.where(F.col("_file") == k).select(*rows.columns).coalesce(1).write.mode("append").parquet(folder)
