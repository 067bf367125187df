"""Quality rules: a learned decision list over statistics of a text.

``statistics`` counts, per whole text, what rules may look at. ``learn`` grows and prunes rules by
sequential covering: a rule is a conjunction of thresholds for *low* quality; conditions are added
by FOIL gain on two thirds of the labelled rows and taken off again, last first, while that does
not lower (p - n) / (p + n) on the other third; rows a rule covers leave, and the next one is
grown, until a rule is wrong more often than right on the pruning rows. ``verdict`` turns the list
into one ordered Spark conditional expression; the default is to keep.

Null texts have no words. Without labelled rows of both kinds the list is empty and keeps all.
Repeated rows each give a row; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crawlflow.llm.common import lean, shrink, whole_texts

#: Labelled rows that are learned from, at most (about).
SAMPLE_ROWS = 20_000
WINDOW = 8
MAX_RULES, MAX_CONDITIONS, THRESHOLDS = 12, 4, 48
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_chars", "n_lines", "n_distinct_words", "n_upper", "n_punct", "n_digits", "n_same_next")
COUNTS_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS + MORE)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more. Ranks of 1, 2, 4, 8 words are exact names."""
    if len(ids) <= window:
        return 0
    rank, span = ids, 1
    while span < window:
        rank = rank[:-span] * (int(rank.max()) + 1) + rank[span:]
        _, rank, count = np.unique(rank, return_inverse=True, return_counts=True)
        if count.max() == 1:
            return 0
        span *= 2
    twice = np.concatenate([[0], (count[rank] > 1).astype(np.int64), [0]])
    covered = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice[1:-1])
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int(np.count_nonzero(np.cumsum(covered)[:-1]))


def count_text(text: str) -> tuple[int, ...]:
    words = text.encode().split()  # of bytes, so at ASCII white space alone
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    points = np.frombuffer(text.encode("utf-8"), np.uint8)
    kinds = np.bincount(KIND[points], minlength=4)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(text),
        len(lines),
        len(names),
        int(kinds[1]),
        int(kinds[2]),
        int(kinds[3]),
        int(np.count_nonzero(ids[1:] == ids[:-1])),
    )


#: Of each byte: 1 upper-case ASCII, 2 ASCII punctuation, 3 digit, 0 other.
KIND = np.zeros(256, np.int64)
KIND[[*range(65, 91)]] = 1
KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2
KIND[[*range(48, 58)]] = 3


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [count_text(t.as_py()) for t in batch.column("text")]
        table = np.array(found, np.int64).reshape(len(found), len(COUNTS + MORE))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(table[:, k]) for k in range(table.shape[1]))],
            ["doc_id", *COUNTS, *MORE],
        )


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row."""
    return whole_texts(docs).mapInArrow(lean(count_batches), COUNTS_SCHEMA)


#: What rules may test: ratios of two counts (the second at least 1), or a count itself.
FEATURES = {
    "f_words": ("n_words", None),
    "f_word_length": ("word_chars", "n_words"),
    "f_symbols": ("n_symbols", "n_words"),
    "f_dup_lines": ("n_dup_lines", "n_lines"),
    "f_repeats": ("n_repeat_words", "n_words"),
    "f_distinct": ("n_distinct_words", "n_words"),
    "f_upper": ("n_upper", "word_chars"),
    "f_punct": ("n_punct", "word_chars"),
    "f_digits": ("n_digits", "word_chars"),
    "f_line_words": ("n_words", "n_lines"),
    "f_same_next": ("n_same_next", "n_words"),
}


def with_features(counted: DataFrame) -> DataFrame:
    """Add the ratios as columns; built-in arithmetic, so that the rules stay plain comparisons."""
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1)) if b else F.col(a).cast("double")
    return counted.withColumns({name: ratio(*parts) for name, parts in FEATURES.items()})


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x > self.threshold if self.above else x <= self.threshold


def covered(rule: list[Condition], values: dict[str, np.ndarray], n: int) -> np.ndarray:
    found = np.ones(n, bool)
    for condition in rule:
        found &= condition.holds(values)
    return found


def grow(values: dict[str, np.ndarray], low: np.ndarray) -> list[Condition]:
    """Conditions of the highest FOIL gain, one after another, until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(low), bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~low).any() and (inside & low).any():
        p, n = np.count_nonzero(inside & low), np.count_nonzero(inside & ~low)
        best, gain = None, 1e-9
        for feature, x in values.items():
            for threshold in np.unique(np.quantile(x[inside], np.linspace(0, 1, THRESHOLDS), method="lower")):
                for above in (True, False):
                    hit = inside & ((x > threshold) if above else (x <= threshold))
                    p1, n1 = np.count_nonzero(hit & low), np.count_nonzero(hit & ~low)
                    if p1 and (g := p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))) > gain:
                        best, gain = Condition(feature, above, float(threshold)), g
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(values)
    return rule


def worth(rule: list[Condition], values: dict[str, np.ndarray], low: np.ndarray) -> float:
    hit = covered(rule, values, len(low))
    p, n = np.count_nonzero(hit & low), np.count_nonzero(hit & ~low)
    return (p - n) / (p + n) if p + n else -1.0


def cover(values: dict[str, np.ndarray], low: np.ndarray, prune_row: np.ndarray) -> list[list[Condition]]:
    """The ordered rules for low quality."""
    rules: list[list[Condition]] = []
    left = np.ones(len(low), bool)
    while len(rules) < MAX_RULES:
        grow_at, prune_at = left & ~prune_row, left & prune_row
        if not (low & grow_at).any():
            break
        part = lambda at: ({k: v[at] for k, v in values.items()}, low[at])
        rule = grow(*part(grow_at))
        while len(rule) > 1 and worth(rule[:-1], *part(prune_at)) >= worth(rule, *part(prune_at)):
            rule = rule[:-1]
        if not rule or worth(rule, *part(prune_at)) <= 0:
            break
        rules.append(rule)
        left &= ~covered(rule, values, len(low))
    return rules


def learn(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> list[list[Condition]]:
    """Rules for ``quality = 0``, from at most about ``sample_rows`` labelled documents."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = shrink(known, sample_rows, known.count(), salt="quality")
    texts = docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    rows = with_features(statistics(texts)).join(F.broadcast(known), "doc_id").select(
        "quality", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune"), *FEATURES
    ).toPandas()
    if rows.empty or rows["quality"].nunique() < 2:
        return []
    values = {f: rows[f].to_numpy(float) for f in FEATURES}
    return cover(values, (rows["quality"] == 0).to_numpy(), rows["prune"].to_numpy(bool))


def verdict(rules: list[list[Condition]]) -> Column:
    """True for rows to keep: the first rule that holds rejects, the default keeps."""
    out = F
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            test = test & (F.col(c.feature) > c.threshold if c.above else F.col(c.feature) <= c.threshold)
        out = out.when(test, F.lit(False))
    return F.lit(True) if out is F else out.otherwise(F.lit(True))


def apply_rules(docs: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """``doc_id``, the counts, the features and ``good``, the verdict of the list."""
    return with_features(statistics(docs)).withColumn("good", verdict(rules))
