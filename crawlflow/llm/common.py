"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from crawlflow.session import small_batches

#: Bytes of text that the array steps look at together; temporary arrays are some 50 times that.
SLICE_BYTES = 1 << 20


def lean(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``step`` of mapInArrow, giving memory back to the system between batches and at the end.

    Python workers are used again by later tasks, and would else keep the most that any step ever took.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in step(batches):
            yield batch
            del batch
            pa.default_memory_pool().release_unused()
        give_back()

    return run


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` alone, a null text as the empty one; other columns cannot clash."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))


def remainder(modulus: int) -> Column:
    """crc32 of the decimal ``doc_id``, modulo ``modulus``; null if there is no id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def shrink(docs: DataFrame, rows: int, total: int, *, salt: str) -> DataFrame:
    """About ``rows`` of ``total`` rows, picked by a hash of ``doc_id``: the same ones on every run."""
    if total <= rows:
        return docs
    slots = 1 << 30
    return docs.where(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(slots)) < rows * slots // total)


def slices(batch: pa.RecordBatch, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``max_bytes`` of text; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        before = ends[start] - size[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of the texts on end, and the n + 1 offsets at which texts begin."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    joined = b"".join(t.as_buffer() for t in texts if t.is_valid and len(t.as_buffer()))
    return np.frombuffer(joined, np.uint8), offsets
