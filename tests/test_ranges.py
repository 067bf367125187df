import glob
import os
import random

from pyspark.sql import functions as F

from crawlflow.operators import ranges
from crawlflow.session import materialize, materialize_compact, shared_dir


def test_ranges_are_in_order_and_whole(spark, monkeypatch):
    """Nulls first, texts by their bytes; equal keys stay together and no row is lost or doubled."""
    monkeypatch.setattr(ranges, "ROWS_A_RANGE", 30)
    monkeypatch.setattr(ranges, "ROWS_PACKED", 64)
    rng = random.Random(2)
    rows = [(rng.choice([None, "", "a", "é", "😀", "b\n", "aa"]), rng.choice([None, -3, 0, 7]), rng.random() < 0.5) for _ in range(700)]
    df = spark.createDataFrame(rows, "t string, n long, f boolean").repartition(4)
    for order in (["t", "n"], ["n", "t"]):
        starts = ranges.range_starts(df, order)
        assert 0 < len(starts) < 8 and starts == sorted(starts)
        dealt = ranges.in_ranges(df, order, starts).withColumn("part", F.spark_partition_id())
        got = dealt.collect()
        assert sorted(map(repr, [tuple(r)[:3] for r in got])) == sorted(map(repr, rows))
        key = lambda r: tuple((r[c] is not None, r[c].encode() if isinstance(r[c], str) else r[c]) for c in order)
        keys = sorted((r.part, key(r)) for r in got)
        assert [k for _, k in keys] == sorted(map(key, got))
        assert len({k for _, k in keys}) == len(set(keys))
        assert len({p for p, _ in keys}) > 1
    assert ranges.range_starts(df.limit(0), ["t"]) == []
    assert ranges.in_ranges(df.limit(0), ["t"], []).count() == 0


def test_rows_travel_in_blocks(spark):
    """One row for each block is shuffled, a few bytes for each row in it."""
    df = spark.range(40_000).select(F.format_string("http://%08d", F.col("id") * 7919 % 100_003).alias("t"), F.lit(1).alias("n"))
    sent = df.coalesce(1).mapInArrow(ranges._pack(ranges.to_arrow_schema(df.schema), ["t"], [((True, b"http://0005"),)]), "_range int, _block binary")
    total = sent.agg(F.count("*"), F.sum(F.octet_length("_block"))).first()
    assert total[0] == 2 and total[1] < 4 * 40_000


def test_what_a_compact_table_was_made_of_leaves_the_disk(spark):
    first = materialize(spark.range(1000), "spent")
    folder = first.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    second = materialize_compact(first.repartition(3, "id").groupBy("id").count(), "kept", spent=first)
    assert not os.path.isdir(folder) and second.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert glob.glob(f"{shared_dir(spark).removeprefix('file:')}/kept-*/*.zstd.parquet")
