"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a 64-bit fingerprint belongs to class m(i) = 1 + i mod 7, seen as a vector of three bits.
Table v = 1..7 keeps the bits with odd parity of m(i) & v. For any two bits some v masks both out,
as two equations over three unknowns have a solution that is not zero; so fingerprints that differ
in at most two bits agree in some table, always and not just probably. Inside a table's group only
the bits that are masked out can differ, and two members are at most two bits apart exactly if
some value is within one bit of both. So a member is listed under itself and each of its
one-bit neighbours, at most 29 members meet at one value, and they are linked to the smallest:
no pairs are formed, and no link between groups of different fingerprints is lost.

Documents of equal fingerprint are one node, so copies never meet pairwise. Null and empty texts
and texts without a word have fingerprint zero and link like any other. Rows without ``doc_id`` take
part, but a component is named by its smallest ``doc_id`` (null if there is none). Repeated rows
each give a row; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from crawlflow.llm.common import lean, whole_texts
from crawlflow.llm.graph import components
from crawlflow.session import materialize

BITS, RADIUS, WORDS, SEED = 64, 2, 3, 42
TABLES = tuple(range(1, 2 ** (RADIUS + 1)))
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def kept(table: int) -> list[bool]:
    return [((1 + i % len(TABLES)) & table).bit_count() % 2 == 1 for i in range(BITS)]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprint(text: str) -> int:
    words = text.encode().lower().split()  # of bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[k:] for k in range(WORDS)))) if len(words) >= WORDS else [b" ".join(words)]
    n = max(1, len(words) - WORDS + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return whole_texts(docs).mapInArrow(lean(run), "doc_id long, fp long")


def links(nodes: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect whatever ``nodes`` (distinct ``fp``) are two bits apart or less."""
    masks = [sum(1 << i for i in range(BITS) if kept(t)[i]) for t in TABLES]
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])
    keyed = nodes.select("fp", F.posexplode(keys).alias("t", "key"))
    met = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").select("t", "key")
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << i)) for i in range(BITS) if not kept(t)[i]]) for t in TABLES])
    balls = keyed.join(met, ["t", "key"], "left_semi").select("t", "fp", F.explode(F.element_at(flips, F.col("t") + 1)).alias("flip"))
    # At most one member per flip: a bounded list, however large the table's group is.
    near = balls.groupBy("t", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre")).agg(F.collect_set("fp").alias("members"))
    star = near.where(F.size("members") > 1).select(F.array_min("members").alias("b"), F.explode("members").alias("a"))
    return star.where("a <> b").select("a", "b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every row."""
    marked = materialize(fingerprints(docs), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(links(nodes.select("fp"))).withColumnRenamed("node", "fp")
    placed = nodes.join(found, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    named = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = placed.join(named, "component").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without rows whose component holds a smaller ``doc_id``. Rows without id stay."""
    spared = near_duplicates(docs).where("doc_id > component_id").select("doc_id")
    return docs.join(spared, "doc_id", "left_anti").select(*docs.columns)
