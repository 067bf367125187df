"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A document is contaminated by an item of n words if some stretch of it is at most
floor((1 - similarity) * n) word edits away from the item. Windows of the items' sizes start at
every word of every document. The CGK random walk embeds a window's words into a longer sequence:
it emits the current word and moves on or stays by a random bit of (step, word). Windows a few
edits apart follow the same walk again soon after each edit, so their embeddings have a small
Hamming distance; ``SAMPLES`` positions of the embedding make a bucket key, and ``REPEATS``
independent walks and samples give every near window many chances (``expected_recall``). Windows
that meet an item of their size in a bucket are verified by exact semi-global edit distance.

Walks drift apart with the number of edits, so long items, deletions above all, would often be
missed by buckets alone. Therefore items are also cut into k + 1 pieces: k edits leave one of them
as it is, at most k words off its place. Windows that hold a piece of an item of their size there
are verified too, so that no match is lost, whatever the item's size and the kind of edits.

Before embedding, windows are dropped that provably cannot match: k edits spoil at most 2 k of a
window's n - 1 word pairs, so the others must be pairs of an item of that size. Those pairs sit in a
Bloom filter of fixed size; it never drops a match, and if a huge benchmark fills it, only time
is lost.

Items of fewer than ``LEAST_WORDS`` words are no evidence and match nothing. Null and empty texts
have no words. Repeated rows give one set of hits per ``doc_id``; rows without ``doc_id`` cannot be
named in hits and stay in ``clean``. Only ``doc_id`` (``item_id``) and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crawlflow.llm.common import lean, slices, whole_texts
from crawlflow.llm.words import Words, mix, words_of
from crawlflow.session import materialize

SIMILARITY = 0.8
LEAST_WORDS = 5
REPEATS, SAMPLES = 16, 3
BLOOM_BITS = 1 << 22
SLICE = 4 << 20


def expected_recall(differing: float) -> float:
    """Chance that windows whose embeddings differ at this share of positions meet in a bucket."""
    return 1 - (1 - (1 - differing) ** SAMPLES) ** REPEATS


def edits(n: int, similarity: float = SIMILARITY) -> int:
    return math.floor((1 - similarity) * n + 1e-9)


def pair_bits_at(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Bloom position of the words at ``at`` with the next ones, for an item size; 0: of any."""
    with np.errstate(over="ignore"):
        pair = mix(hashes[at], 1) + hashes[at + 1] + np.asarray(size).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return (mix(pair, 2) & np.uint64(BLOOM_BITS - 1)).astype(np.int64)


def pair_bits(hashes: np.ndarray, size: int) -> np.ndarray:
    return pair_bits_at(hashes, np.arange(len(hashes) - 1), size)


def sampled(sizes: np.ndarray) -> np.ndarray:
    """Positions of the embedding that make the keys: window by repeat by sample. An embedding moves
    on every second step on average, so they are spread over twice the window's words."""
    share = np.random.default_rng(7).random((REPEATS, SAMPLES))
    return (share[None] * 2 * sizes[:, None, None]).astype(np.int64)


def bucket_keys(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The keys of windows, one column per repeat: all walks go step by step together. Positions
    follow the item size; a window at a text's end may end before it."""
    at = np.zeros((len(starts), REPEATS), np.int64)
    keys = np.zeros((len(starts), REPEATS), np.uint64)
    wanted = sampled(sizes)
    repeat = np.arange(REPEATS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for step in range(int(wanted.max(initial=-1)) + 1):
            place = starts[:, None] + at
            word = np.where(place < ends[:, None], hashes[np.minimum(place, len(hashes) - 1)], np.uint64(0))
            for k in range(SAMPLES):
                hit = wanted[:, :, k] == step
                keys[hit] += mix(word[hit], 100 + k)
            coin = mix(word + (repeat[None] + np.uint64(REPEATS * step)) * np.uint64(0x9E3779B97F4A7C15), 3)
            at += (coin >> np.uint64(63)).astype(np.int64)
        return mix(keys + repeat[None], 4)


def piece_words(n: int, similarity: float) -> int:
    """Words of a piece of an item."""
    return max(1, n // (edits(n, similarity) + 1))


def piece_keys(hashes: np.ndarray, at: np.ndarray, n: int, similarity: float) -> np.ndarray:
    """Keys of the stretches of a piece's length at ``at``, for an item size."""
    with np.errstate(over="ignore"):
        key = np.full(at.shape, n, np.uint64)
        for k in range(piece_words(n, similarity)):
            key = mix(key + hashes[at + k], 200)
        return key


def pieces_of_item(hashes: np.ndarray, similarity: float) -> list[dict[str, int]]:
    n = len(hashes)
    at = np.arange(edits(n, similarity) + 1) * piece_words(n, similarity)
    at = at[at + piece_words(n, similarity) <= n]
    keys = piece_keys(hashes, at, n, similarity).view(np.int64)
    return [{"key": int(k), "at": int(a)} for k, a in zip(keys, at, strict=True)]


def pieces_of_windows(
    hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, lo: np.ndarray, hi: np.ndarray, bits: np.ndarray, similarity: float
) -> pa.Array:
    """Per window the stretches between ``lo`` and ``hi`` that may be pieces of items of its size."""
    which, keys, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        place = lo[rows][:, None] + np.arange(n + 2 * edits(n, similarity))[None]
        row, column = np.nonzero(place + piece_words(n, similarity) <= hi[rows][:, None])
        where, back = np.unique(place[row, column], return_inverse=True)  # windows overlap
        key = piece_keys(hashes, where, n, similarity)
        known = bits[(key & np.uint64(BLOOM_BITS - 1)).astype(np.int64)][back]
        which.append(rows[row[known]])
        keys.append(key[back[known]])
        at.append(where[back[known]] - starts[rows[row[known]]])
    which, keys, at = np.concatenate(which), np.concatenate(keys), np.concatenate(at)
    order = np.argsort(which, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(starts)))]).astype(np.int32)
    pieces = pa.StructArray.from_arrays([pa.array(keys[order].view(np.int64)), pa.array(at[order].astype(np.int32))], ["key", "at"])
    return pa.ListArray.from_arrays(pa.array(offsets), pieces)


def near_windows(words: Words, bits: np.ndarray, sizes: list[int], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of windows that hold enough word pairs of items of their size."""
    starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(words.hashes) < 2 or not sizes:
        return starts[0], found[0]
    need_of = {n: max(1, n - 1 - 2 * edits(n, similarity)) for n in sizes}
    end_of = words.first[words.rows + 1]
    # Texts with too few pairs of any item are left out at once.
    any_size = bits[pair_bits(words.hashes, 0)] & (words.rows[1:] == words.rows[:-1])
    held = np.bincount(words.rows[:-1][any_size], minlength=len(words.first) - 1)
    same = any_size & (held >= min(need_of.values()))[words.rows[:-1]]
    some = np.flatnonzero(same)
    for n in sizes:
        need = need_of[n]
        hit = np.zeros(len(same), bool)
        hit[some] = bits[pair_bits_at(words.hashes, some, n)]
        total = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
        begin = np.flatnonzero(hit)  # an aligned window may begin up to its edits before a hit
        begin = np.unique((begin[:, None] - np.arange(2 * edits(n, similarity) + 1)[None]).ravel()) if len(begin) else begin
        begin = begin[begin >= 0]
        stop = np.minimum(begin + n, end_of[begin])  # shorter at a text's end
        enough = total[np.maximum(begin, stop - 1)] - total[begin] >= need
        starts.append(begin[enough])
        found.append(np.full(int(enough.sum()), n, np.int64))
    return np.concatenate(starts), np.concatenate(found)


def distance(item: list[int], text: list[int]) -> tuple[int, int]:
    """Fewest edits from ``item`` to any stretch of ``text``, and the first end of such a stretch.
    Bit-parallel over the item's words."""
    peq: dict[int, int] = {}
    for k, w in enumerate(item):
        peq[w] = peq.get(w, 0) | 1 << k
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best, where = score, 0
    for j, w in enumerate(text, 1):
        eq = peq.get(w, 0)
        x = eq | minus
        diagonal = ((((eq & plus) + plus) ^ plus) | x) & full
        h_plus, h_minus = (minus | ~(diagonal | plus)) & full, plus & diagonal
        score += bool(h_plus & top) - bool(h_minus & top)
        h_plus, h_minus = h_plus << 1 & full, h_minus << 1 & full
        plus, minus = (h_minus | ~(x | h_plus) & full) & full, h_plus & x
        if score < best:
            best, where = score, j
    return best, where


PIECES = "array<struct<key: bigint, at: int>>"
PIECE_TYPE = pa.list_(pa.struct([("key", pa.int64()), ("at", pa.int32())]))
WINDOW = f"doc_id long, start long, size int, lead int, words binary, keys array<long>, pieces {PIECES}"


def item_rows(benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``item_id, size, words, keys, pieces`` of the items that are long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE):
                words = words_of(part.column("text"))
                sizes = np.diff(words.first)
                long = np.flatnonzero(sizes >= LEAST_WORDS)
                keys = bucket_keys(words.hashes, words.first[long], sizes[long], words.first[long + 1]).view(np.int64)
                body = [words.hashes[words.first[k] : words.first[k + 1]].tobytes() for k in long]
                pieces = [pieces_of_item(words.hashes[words.first[k] : words.first[k + 1]], similarity) for k in long]
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id").take(pa.array(long)), pa.array(sizes[long].astype(np.int32)), pa.array(body, pa.binary()), pa.array(list(keys), pa.list_(pa.int64())), pa.array(pieces, PIECE_TYPE)],
                    ["item_id", "size", "words", "keys", "pieces"],
                )

    texts = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    return texts.mapInArrow(lean(run), f"item_id long, size int, words binary, keys array<long>, pieces {PIECES}")


def filter_of(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The Bloom filter of the items' word pairs, and the sizes of items. The driver gets at most
    ``BLOOM_BITS`` positions, however many items there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(np.frombuffer(w.as_buffer(), np.uint64), n.as_py()) for w, n in zip(batch.column("words"), batch.column("size"), strict=True)]
            at = [pair_bits(words, size) for words, n in pairs for size in (0, n)]
            at = np.unique(np.concatenate(at)) if at else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at)], ["at"])

    bits = np.zeros(BLOOM_BITS, bool)
    bits[items.mapInArrow(lean(run), "at long").distinct().toPandas()["at"].to_numpy(np.int64)] = True
    return bits, sorted(r["size"] for r in items.select("size").distinct().collect())


def piece_filter(items: DataFrame) -> np.ndarray:
    """The Bloom filter of the items' pieces; bounded like ``filter_of``."""
    bits = np.zeros(BLOOM_BITS, bool)
    at = items.select(F.explode("pieces.key").alias("key")).select(F.col("key").bitwiseAND(F.lit(BLOOM_BITS - 1)).alias("at")).distinct()
    bits[at.toPandas()["at"].to_numpy(np.int64)] = True
    return bits


def windows(docs: DataFrame, bits: np.ndarray, piece_bits: np.ndarray, sizes: list[int], similarity: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((np.packbits(bits), np.packbits(piece_bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, piece_bits = (np.unpackbits(b).astype(bool) for b in shared.value)
        for batch in batches:
            for part in slices(batch, SLICE):
                words = words_of(part.column("text"))
                starts, size = near_windows(words, bits, sizes, similarity)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                for k in range(0, len(starts), 4096):
                    s, n = starts[k : k + 4096], size[k : k + 4096]
                    row = words.rows[s]
                    spare = np.array([edits(int(x), similarity) for x in n])
                    lo = np.maximum(s - spare, words.first[row])
                    hi = np.minimum(s + n + spare, words.first[row + 1])
                    pieces = pieces_of_windows(words.hashes, s, n, lo, hi, piece_bits, similarity)
                    # A match's own window holds a piece, so only such windows are embedded.
                    held = np.flatnonzero(np.diff(pieces.offsets.to_numpy()))
                    s, n, row, lo, hi = s[held], n[held], row[held], lo[held], hi[held]
                    keys = bucket_keys(words.hashes, s, n, np.minimum(s + n, words.first[row + 1]))
                    body = [words.hashes[a:b].tobytes() for a, b in zip(lo, hi, strict=True)]
                    columns = [pa.array(ids[row]), pa.array(s - words.first[row]), pa.array(n.astype(np.int32)), pa.array((s - lo).astype(np.int32)), pa.array(body, pa.binary()), pa.array(list(keys.view(np.int64)), pa.list_(pa.int64()))]
                    columns.append(pieces.take(pa.array(held)))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "size", "lead", "words", "keys", "pieces"])

    return whole_texts(docs).where("doc_id is not null").mapInArrow(lean(run), WINDOW)


HIT = "doc_id long, item_id long, start long, edits int, similarity double"


def verified(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs of a window and an item that are within the item's edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                item = np.frombuffer(r["item_words"], np.uint64).tolist()
                best, end = distance(item, np.frombuffer(r["words"], np.uint64).tolist())
                if best <= edits(len(item), similarity):
                    start = max(0, r["start"] - r["lead"] + end - len(item))
                    rows.append((r["doc_id"], r["item_id"], start, best, 1 - best / len(item)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in HIT.split(", ")])

    return pairs.mapInArrow(lean(run), HIT)


def leaks(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, similarity, edits, start``: each document and item it holds, at its best
    place; ``start`` is the word at which an unedited item would begin there."""
    items = materialize(item_rows(benchmark, similarity), "items")
    bits, sizes = filter_of(items)
    found = materialize(windows(docs, bits, piece_filter(items), sizes, similarity).withColumn("wid", F.xxhash64("doc_id", "start", "size", "words")), "windows")
    probes = found.select("wid", "size", F.posexplode("keys").alias("repeat", "key"))
    buckets = items.select("item_id", "size", F.posexplode("keys").alias("repeat", "key"))
    near = probes.join(buckets, ["size", "repeat", "key"]).select("wid", "item_id")
    spare = F.floor((1 - F.lit(similarity)) * F.col("size") + F.lit(1e-9))
    stretches = found.select("wid", "size", F.inline("pieces")).withColumnRenamed("at", "place")
    pieces = items.select("item_id", "size", F.inline("pieces"))
    held = stretches.join(pieces, ["size", "key"]).where(F.abs(F.col("place") - F.col("at")) <= spare).select("wid", "item_id")
    met = near.union(held).distinct()
    pairs = (
        met.join(found.drop("keys", "pieces").dropDuplicates(["wid"]), "wid")
        .join(items.select("item_id", F.col("words").alias("item_words")), "item_id")
        .select("doc_id", "item_id", "start", "lead", "words", "item_words")
    )
    best = F.min(F.struct("edits", "start", "similarity")).alias("b")
    return verified(pairs, similarity).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.similarity", "b.edits", "b.start")


def clean(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = leaks(docs, benchmark, similarity=similarity).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
