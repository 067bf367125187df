"""Connected components of large sparse graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crawlflow.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges`` (``a, b``, longs): the smallest node reachable.

    Each round every node takes the smallest label of its neighbours and then the label of that
    label's node (pointer jumping), so the rounds grow with the logarithm of a component's width.
    A round is written to the shared folder, so nothing is recomputed if executors are lost. A hot
    node is only ever a join key with one row on the other side, which adaptive execution splits.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("l")).withColumnRenamed("a", "v"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("l").alias("m"))
        lower = labels.join(near, labels["v"] == near["a"]).select("v", "l", F.least("l", "m").alias("m"))
        jump = labels.select(F.col("v").alias("w"), F.col("l").alias("j"))
        moved = lower.join(jump, lower["m"] == jump["w"]).select("v", F.least("m", "j").alias("n"), (F.least("m", "j") < F.col("l")).alias("moved"))
        step = materialize(moved, "labels")
        labels = step.select("v", F.col("n").alias("l"))
        if step.where("moved").isEmpty():
            return labels.select(F.col("v").alias("node"), F.col("l").alias("component"))
