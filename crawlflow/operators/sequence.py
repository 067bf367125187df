"""Dense row positions over a whole table, without a one-partition window over its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window as W

from crawlflow.operators.ranges import in_ranges, range_starts
from crawlflow.session import materialize, materialize_compact


def with_position(df: DataFrame, *order: str, name: str = "pos", first: int = 0) -> DataFrame:
    """Add the position, from ``first`` on, of each row in the total order ``order`` (a unique key).

    The rows are range-sorted and written once; the offset of a sorted partition is the row
    count of those before it. Only one row per shuffle partition is broadcast.
    """
    return _with_offsets(materialize(_numbered(df.orderBy(*order)), name), df.columns, name, first)


def with_position_compact(df: DataFrame, *order: str, name: str = "pos", first: int = 0) -> DataFrame:
    """``with_position`` for tables far larger than their input: rows are stored sorted, and travel in packed blocks.

    ``df`` is computed once; what it was made of and the first copy leave the disk as soon as they have been read.
    """
    rows = materialize_compact(df.sortWithinPartitions(*order), f"{name}_rows")
    ordered = in_ranges(rows, [*order], range_starts(rows, [*order])).sortWithinPartitions(*order)
    return _with_offsets(materialize_compact(_numbered(ordered), name, spent=rows), df.columns, name, first)


def _numbered(ordered: DataFrame) -> DataFrame:
    """Add the partition and the row in it."""
    row_bits = 33  # monotonically_increasing_id keeps the row number in the low 33 bits
    return ordered.withColumn("_mid", F.monotonically_increasing_id()).select(
        *ordered.columns,
        F.shiftright("_mid", row_bits).cast("int").alias("_part"),
        F.col("_mid").bitwiseAND((1 << row_bits) - 1).alias("_row"),
    )


def _with_offsets(stored: DataFrame, columns: list[str], name: str, first: int) -> DataFrame:
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return stored.join(F.broadcast(offsets), "_part").select(
        *columns, (F.col("_offset") + F.col("_row") + first).alias(name)
    )
