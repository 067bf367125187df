"""Toxicity by a weighted lexicon.

Texts are folded (lower case, look-alike letters of other scripts, digits that stand for letters,
invisible characters), and a lexicon of words and word beginnings is matched by an Aho-Corasick
automaton. A hit inside an exception phrase does not count. The weights of all hits are divided by
a measure of the text's length and mapped to a score of 0 to 1.

``learn`` takes weights, exception phrases and the scale from labelled rows: a pattern is a folded
word or the first ``PREFIXES`` characters of words; it enters the lexicon if documents that hold it
are toxic far oftener than others (log-odds of at least ``MIN_LIFT``) and that is no accident
(log-likelihood ratio of at least ``MIN_EVIDENCE``). Copies would vote as often as they are copied,
so one document of each group that shares a smallest shingle hash teaches. A phrase of a hit and
its neighbour that occurs in ``MIN_EXCEPTION`` or more documents and no toxic one is an exception.

Null and empty texts score 0, as do all texts if nothing was learned. Repeated rows each give a
row; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from crawlflow.llm.common import lean, remainder, shrink, small_batches, whole_texts

#: Labelled rows that are learned from, at most (about), and entries of the lexicon.
SAMPLE_ROWS = 24_000
MAX_TERMS = 4_000
PREFIXES = (4, 5, 6)
MIN_LIFT, MIN_EVIDENCE, MIN_EXCEPTION = 2.0, 30.0, 3
#: Words from which on a text's length lowers its score by half.
LENGTH_WORDS = 1000
THRESHOLD = 0.3
HELD_OUT = (4, 2)

# Look-alike letters and digits that stand for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "и": "u", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ɡ": "g", "ı": "i", "ⅼ": "l", "ⅰ": "i", "ѵ": "v", "ո": "n", "ս": "u", "օ": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"


def folding() -> dict[int, str | None]:
    """One table: letters to a plain form, ASCII punctuation and spaces to a space, l as i."""
    out: dict[int, str | None] = {c: " " for c in range(128) if not chr(c).isalnum()}
    out |= {ord(k): v for k, v in {**LOOK_ALIKES, **DIGITS}.items()}
    out |= {0xFF01 + k: out.get(0x21 + k, chr(0x21 + k)) for k in range(94)}  # full-width forms
    out |= {c: None for c in map(ord, INVISIBLE)}
    out |= {0x0300 + k: None for k in range(0x70)}  # combining accents
    out |= {c: " " for c in (0xA0, 0xAB, 0xBB, 0x2013, 0x2014, 0x2018, 0x2019, 0x201C, 0x201D, 0x2026)}
    out |= {k: v.replace("l", "i") for k, v in out.items() if v}
    out[ord("l")] = "i"
    return out


FOLD = folding()


def fold(text: str) -> str:
    """The folded text with a space before and after; 1, l and i are one letter."""
    return f" {text.lower().translate(FOLD)} "


@dataclass
class Lexicon:
    """Weighted patterns: ' word ' or ' begin' (any word that begins so), folded."""

    weights: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    scale: float = 1.0
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "scale": self.scale, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            found = ahocorasick.Automaton()
            for pattern, weight in self.weights.items():
                found.add_word(pattern, (pattern, weight))
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def hits(self, folded: str) -> dict[int, float]:
        """Start of each word that is hit, and its largest weight."""
        found: dict[int, float] = {}
        if self.weights:
            for end, (pattern, weight) in self.automaton().iter(folded):
                start = end - len(pattern) + 2
                found[start] = max(weight, found.get(start, 0.0))
        return found

    def mass(self, text: str) -> float:
        """Weights of the hits outside exception phrases, normalised by length."""
        folded = fold(text)
        total = 0.0
        for start, weight in self.hits(folded).items():
            if self.exceptions and any(p in self.exceptions for p in phrases(folded, start)):
                continue
            total += weight
        return total and total / (1 + folded.count(" ") / LENGTH_WORDS)

    def score(self, text: str) -> float:
        mass = self.mass(text)
        return mass / (mass + self.scale) if mass else 0.0


def phrases(folded: str, start: int) -> list[str]:
    """The hit word with the word before and with the word after."""
    word, *after = folded[start : start + 200].split(" ", 1)
    before = folded[max(0, start - 100) : start].split()
    after = after[0].split() if after else []
    return [f"{b} {word}" for b in before[-1:]] + [f"{word} {a}" for a in after[:1]]


def patterns(text: str) -> set[str]:
    words = set(fold(text).split())
    found = {f" {w} " for w in words if len(w) > 2}
    for n in PREFIXES:
        found |= {f" {w[:n]}" for w in words if len(w) > n}
    return found


def representatives(rows: DataFrame) -> DataFrame:
    """``doc_id`` of one row per group of copies: rows that share the smallest hash of their
    three-word shingles under any of three seeds are taken as copies."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for text in batch.column("text").to_pylist():
                words = re.findall(r"\w+", text.lower())
                grams = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
                keys.append([min(xxhash.xxh64_intdigest(g, s) >> 1 for g in grams) for s in range(3)])
            table = np.array(keys, np.int64).reshape(len(keys), 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(table[:, k]) for k in range(3))], ["doc_id", "k0", "k1", "k2"]
            )

    left = rows.mapInArrow(lean(smallest), "doc_id long, k0 long, k1 long, k2 long")
    for key in ("k0", "k1", "k2"):
        left = left.groupBy(key).agg(F.min(F.struct("doc_id", "k0", "k1", "k2")).alias("_r")).select("_r.*")
    return left.select("doc_id")


def learn(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """The lexicon from at most about ``sample_rows`` labelled documents that are not held out.

    The driver receives at most ``MAX_TERMS`` patterns, as many phrases, and one number per
    sampled row.
    """
    modulus, left = HELD_OUT
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)").where(remainder(modulus) != left)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    known = shrink(known, sample_rows, known.count(), salt="toxic")
    rows = whole_texts(docs).join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    rows = rows.join(F.broadcast(representatives(rows)), "doc_id")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen[toxic].update(patterns(text))
                seen[toxic][""] += 1
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([seen[k][w] for w in names], pa.int64()) for k in (1, 0))],
                ["pattern", "pos", "neg"],
            )

    counted = rows.mapInArrow(lean(counts), "pattern string, pos long, neg long").groupBy("pattern").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    total = counted.where("pattern = ''").collect()
    if not total or not total[0]["pos"] or not total[0]["neg"]:
        return Lexicon({})
    all_pos, all_neg = float(total[0]["pos"]), float(total[0]["neg"])
    lift = F.log((F.col("pos") + 0.5) / (all_pos + 1)) - F.log((F.col("neg") + 0.5) / (all_neg + 1))
    # Twice the log-likelihood ratio against "as toxic as any document".
    n = F.col("pos") + F.col("neg")
    part = lambda k, base: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (n * base))).otherwise(0.0)
    whole = all_pos + all_neg
    evidence = 2 * (part("pos", all_pos / whole) + part("neg", all_neg / whole))
    kept = (
        counted.where("pattern <> ''").withColumn("lift", lift).withColumn("evidence", evidence)
        .where((F.col("lift") >= MIN_LIFT) & (F.col("evidence") >= MIN_EVIDENCE))
        .orderBy(F.desc("evidence"), "pattern").limit(MAX_TERMS).select("pattern", "lift").collect()
    )
    lexicon = Lexicon({r["pattern"]: r["lift"] for r in kept})

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(), Counter()]
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                folded = fold(text)
                found[toxic].update({p for at in lexicon.hits(folded) for p in phrases(folded, at)})
            names = list(found[0] | found[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([found[k][w] for w in names], pa.int64()) for k in (1, 0))],
                ["phrase", "pos", "neg"],
            )

    allowed = (
        rows.mapInArrow(lean(near), "phrase string, pos long, neg long").groupBy("phrase")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where((F.col("pos") == 0) & (F.col("neg") >= MIN_EXCEPTION))
        .orderBy(F.desc("neg"), "phrase").limit(MAX_TERMS).select("phrase").collect()
    )
    lexicon = Lexicon(lexicon.weights, frozenset(r["phrase"] for r in allowed))

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mass = [lexicon.mass(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(mass, pa.float64())], ["toxic", "mass"])

    measured = rows.mapInArrow(lean(masses), "toxic int, mass double").toPandas()
    return Lexicon(lexicon.weights, lexicon.exceptions, scale_of(measured["mass"].to_numpy(), measured["toxic"].to_numpy()))


def scale_of(mass: np.ndarray, toxic: np.ndarray) -> float:
    """The mass at which the score is one half, so that ``THRESHOLD`` lies at the best F1."""
    order = np.argsort(-mass, kind="stable")
    mass, toxic = mass[order], toxic[order]
    right = np.cumsum(toxic)
    f1 = np.where(mass > 0, 2 * right / (np.arange(1, len(mass) + 1) + toxic.sum()), 0)
    last = np.concatenate([mass[1:] != mass[:-1], [True]])  # a threshold takes all rows of a mass
    f1 = np.where(last, f1, 0)
    if not len(f1) or f1.max() <= 0:
        return 1.0
    at = int(np.argmax(f1))
    below = mass[at + 1] if at + 1 < len(mass) else 0.0
    return float((mass[at] + below) / 2 * (1 - THRESHOLD) / THRESHOLD)


def toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most MAX_TERMS entries

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in batches:
            found = [lexicon.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    modulus, left = HELD_OUT
    scored = whole_texts(docs).mapInArrow(lean(scores), "doc_id long, score double")
    return scored.select(
        "doc_id", (remainder(modulus) == left).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def clean(docs: DataFrame, lexicon: Lexicon, *, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, all columns, without the rows whose text scores ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most MAX_TERMS entries
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")  # texts alone go through Python
    def score(texts: pa.Array) -> pa.Array:
        found = pa.array([shared.value.score(t.as_py() or "") for t in texts], pa.float64())
        pa.default_memory_pool().release_unused()
        return found

    return docs.where(score("text") < threshold)
