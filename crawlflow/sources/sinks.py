"""Sinks: the seed table, the message topic, articles and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The seeds every new table starts with, and the topic URLs are published to.
FIRST_SEEDS = ("www.google.com", "www.yahoo.com")
TOPIC = "urls"


def first_seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(u,) for u in FIRST_SEEDS], "url string")


def seeds_to_append(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Seeds not yet in the table: the URL is the row key, so a second insert changes nothing."""
    return new.select("url").distinct().join(existing.select("url"), "url", "left_anti")


def append_seeds(new: DataFrame, existing: DataFrame, path: str) -> None:
    seeds_to_append(new, existing).write.mode("append").parquet(path)


def publish_frame(urls: DataFrame) -> DataFrame:
    """What the message sink takes: the URL as value, no key, partition 0."""
    return urls.select(
        F.lit(TOPIC).alias("topic"), F.col("url").alias("value"), F.lit(0).alias("partition")
    )


def publish(urls: DataFrame, servers: str) -> None:
    """Write to a message broker; needs Spark's Kafka package on the class path."""
    (
        publish_frame(urls)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "1")
        .save()
    )


def write_articles(articles: DataFrame, path: str) -> None:
    articles.write.mode("append").parquet(path)


def write_rules(rules: DataFrame, path: str) -> None:
    """Final rules, range-sorted by beta and alpha across the files."""
    rules.orderBy("beta", "alpha").write.mode("overwrite").parquet(path)
