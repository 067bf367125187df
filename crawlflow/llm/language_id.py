"""Language identification by language-bitmask n-gram filters.

Learning counts, per language, the documents that hold each character n-gram (n = 1, 2, 3, over
lower-cased letters with one space around words) in a bounded sample of labelled rows, and keeps
the n-grams that at least ``min_share`` of the language's sampled documents hold, and ``RELATIVE``
times the share of the language that holds them most, as texts quote others. They go into one
Bloom filter whose slots hold a bitmask of languages instead of a bit, of as many 64-bit words as
the languages need: the bit-sliced form of one filter per language. An n-gram probes ``PROBES`` slots; the AND of the masks names every language
that has it (and, rarely, one that has not).

A text is decided by the popcounts per language over all its n-grams. A language whose slots are
filled to the share f gets a false hit with probability q = f ** PROBES, so its count c of n becomes
(c - n q) / (1 - q). N-grams weigh by their length. The largest corrected count wins; ties go to the first language in alphabetical order; the score is the
winner's share of it against the runner-up, 0 to 1.

Null texts and texts without a letter are ``und`` with score 0. Rows without language teach nothing.
If nothing was learned (no labelled row), every text is ``und``. Repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from crawlflow.llm.common import lean, remainder, shrink, slices

#: Labelled rows that are learned from, at most (about), and n-grams kept per language and length.
SAMPLE_ROWS = 20_000
MAX_GRAMS = 20_000
MIN_SHARE = 0.002
RELATIVE = 0.4
SLOTS = 1 << 18
PROBES = 3
WORD_BITS = 64
SIZES = (1, 2, 3)
UNDETERMINED = "und"
HELD_OUT = (3, 1)

#: 1 for code points that are letters, over the whole of Unicode.
LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of all texts with single spaces around words, and the row of each."""
    parts = [np.frombuffer(f" {t.as_py().lower() if t.is_valid else ''} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    points = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    letter = LETTER[points]
    first_gap = ~letter & np.concatenate([[True], letter[:-1] | (rows[1:] != rows[:-1])]) if len(points) else letter
    keep = letter | first_gap
    points = np.where(letter, points, 32)[keep]
    return points, rows[keep]


def gram_keys(points: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A 63-bit key (21 bits a character) of each n-gram that lies in one text, and its row."""
    if len(points) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.zeros(len(points) - n + 1, np.uint64)
    for k in range(n):
        key = (key << np.uint64(21)) | points[k : len(points) - n + 1 + k].astype(np.uint64)
    whole = rows[: len(key)] == rows[n - 1 :]
    if n == 1:
        whole &= points != 32
    return key[whole], rows[: len(key)][whole]


def probes(keys: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    """The slots of each key: double hashing by two mixed halves."""
    mixed = keys * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    low, high = mixed >> np.uint64(40), (mixed >> np.uint64(8)) | np.uint64(1)
    for k in range(PROBES):
        yield ((low + np.uint64(k) * high) & np.uint64(slots - 1)).astype(np.int64)


@dataclass(frozen=True)
class LanguageFilter:
    """Per n-gram length the language bitmasks: a line of slots per 64 languages."""

    languages: tuple[str, ...]
    masks: dict[int, np.ndarray]

    @classmethod
    def build(cls, languages: list[str], grams: dict[tuple[int, str], np.ndarray], slots: int = SLOTS) -> LanguageFilter:
        masks = {n: np.zeros((-(-len(languages) // WORD_BITS), slots), np.uint64) for n in SIZES}
        for (n, language), keys in grams.items():
            word, bit = divmod(languages.index(language), WORD_BITS)
            for at in probes(keys, slots):
                masks[n][word][at] |= np.uint64(1 << bit)
        return cls(tuple(languages), masks)

    def holders(self, keys: np.ndarray, n: int, word: int = 0) -> np.ndarray:
        """The bitmask of languages (of 64, the ``word``-th ones) that contain each n-gram."""
        found = np.full(len(keys), np.uint64(0xFFFFFFFFFFFFFFFF))
        masks = self.masks[n][word]
        for at in probes(keys, len(masks)):
            found &= masks[at]
        return found

    def evidence(self, points: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
        """Corrected counts, one line per text and one column per language."""
        total = np.zeros((n_rows, len(self.languages)))
        for n in SIZES:
            keys, at = gram_keys(points, rows, n)
            many = np.bincount(at, minlength=n_rows)
            for k in range(len(self.languages)):
                word, bit = k // WORD_BITS, np.uint64(1 << k % WORD_BITS)
                if k % WORD_BITS == 0:
                    found = self.holders(keys, n, word)
                hits = np.bincount(at[(found & bit) != 0], minlength=n_rows)
                fill = np.count_nonzero(self.masks[n][word] & bit) / len(self.masks[n][word])
                false = fill**PROBES
                total[:, k] += n * np.maximum(0, hits - many * false) / max(1e-9, 1 - false)
        return total


def learn(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS, min_share: float = MIN_SHARE) -> LanguageFilter:
    """The filter of ``docs`` (``doc_id, text, lang``); only rows with a text and a language teach.

    The driver receives at most ``len(SIZES) * MAX_GRAMS`` n-grams of each language. All languages
    are learned.
    """
    rows = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    total = sum(r["count"] for r in sizes)
    if not total:
        return LanguageFilter((), {n: np.zeros((0, SLOTS), np.uint64) for n in SIZES})
    per_language = max(1, sample_rows // len(sizes))
    sample = None  # the same number of rows of each language, so that a small one is learned as well
    for r in sizes:
        part = shrink(rows.where(F.col("lang") == r["lang"]), per_language, r["count"], salt="lang")
        sample = part if sample is None else sample.unionByName(part)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                points, at = code_points(part.column("text"))
                langs = np.array(part.column("lang").to_pylist(), object)
                for n in SIZES:
                    keys, row = gram_keys(points, at, n)
                    gram, index = np.unique(keys, return_inverse=True)
                    pairs = np.unique(row * max(1, len(gram)) + index)
                    row, index = np.divmod(pairs, max(1, len(gram)))
                    owner = langs[row]
                    for language in sorted(set(owner)):
                        count = np.bincount(index[owner == language], minlength=len(gram))
                        held = np.flatnonzero(count)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([language] * len(held)), pa.array(np.full(len(held), n, np.int32)), pa.array(gram[held].astype(np.int64)), pa.array(count[held])],
                            ["lang", "n", "gram", "docs"],
                        )

    counted = sample.mapInArrow(lean(grams), "lang string, n int, gram long, docs long").groupBy("lang", "n", "gram").agg(F.sum("docs").alias("docs"))
    seen = {r["lang"]: min(r["count"], per_language) for r in sizes}
    of = F.create_map(*[F.lit(x) for k, v in seen.items() for x in (k, float(v))])
    shared = counted.withColumn("share", F.col("docs") / of[F.col("lang")])
    shared = shared.withColumn("most", F.max("share").over(W.partitionBy("n", "gram")))
    first = W.partitionBy("lang", "n").orderBy(F.desc("docs"), "gram")
    own = (F.col("share") >= F.greatest(F.lit(min_share), RELATIVE * F.col("most"))) & ((F.col("docs") > 1) | (of[F.col("lang")] < 10))
    kept = shared.where(own).withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= MAX_GRAMS)
    found = kept.groupBy("lang", "n").agg(F.collect_list("gram").alias("grams")).collect()
    return LanguageFilter.build(sorted(seen), {(r["n"], r["lang"]): np.array(r["grams"], np.int64).astype(np.uint64) for r in found})


def identify(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a bit per language in SLOTS slots per length

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            for part in slices(batch):
                points, rows = code_points(part.column("text"))
                total = np.concatenate([model.evidence(points, rows, part.num_rows), np.zeros((part.num_rows, 2))], axis=1)
                best = np.argmax(total, axis=1)
                top = np.sort(total, axis=1)[:, ::-1]
                worded = np.bincount(rows[points != 32], minlength=part.num_rows) > 0
                known = worded & (best < len(model.languages))
                score = np.divide(top[:, 0] - top[:, 1], top[:, 0], out=np.zeros(part.num_rows), where=known & (top[:, 0] > 0))
                # A text without any known n-gram still gets a learned value: the first one.
                label = names[np.where(known, best, len(model.languages))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(label, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    modulus, left = HELD_OUT
    rows = docs.select(F.col("doc_id").cast("long"), (remainder(modulus) == left).alias("held_out"), "text")
    return rows.mapInArrow(lean(predict), "doc_id long, held_out boolean, lang_pred string, score double")


def train_rows(docs: DataFrame) -> DataFrame:
    """The documents that may teach: crc32 of the id leaves another remainder than the held-out one."""
    modulus, left = HELD_OUT
    return docs.where(remainder(modulus) != left)
