"""Tokens of English text as column expressions, and their stems."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from crawlflow.functions.stem import stem_twice

# Fixed value: word boundaries.
WORD = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{N}_]+)*"

# English stop words.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is",
    "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there",
    "these", "they", "this", "to", "was", "will", "with",
)


def tokens(text: Column) -> Column:
    """Lower-case words without a possessive ``'s`` and without stop words, in text order."""
    words = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower)
    bare = F.transform(
        words,
        lambda w: F.when(
            w.endswith("'s") | w.endswith("’s"), F.substring(w, F.lit(1), F.length(w) - 2)
        ).otherwise(w),
    )
    return F.filter(bare, lambda w: ~w.isin(*STOP_WORDS))


#: Distinct words a task remembers before it starts over; bounds the memory of a worker.
MEMORY = 100_000


def _stem_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Stem Arrow batches of token lists; a word that comes again is looked up."""
    known: dict[str, str] = {}
    for words in batches:
        coded = pc.dictionary_encode(words.flatten())
        vocabulary = coded.dictionary.to_pylist()
        if len(known) > MEMORY:
            known.clear()
        known.update((w, stem_twice(w)) for w in vocabulary if w not in known)
        stemmed = pa.array([known[w] for w in vocabulary], pa.string())
        lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate(([0], lengths.cumsum())), pa.int32())
        mask = words.is_null() if words.null_count else None
        yield pa.ListArray.from_arrays(offsets, stemmed.take(coded.indices), mask=mask)
        del words, coded, vocabulary, stemmed, lengths, offsets, mask
        pa.default_memory_pool().release_unused()


def stems(token_list: Column) -> Column:
    """Tokens stemmed by Porter's algorithm and then by its English successor."""
    return F.arrow_udf(_stem_batches, "array<string>")(token_list)
