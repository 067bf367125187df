"""Words of many texts at once: positions and 64-bit hashes, by array arithmetic."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from crawlflow.llm.common import bytes_of

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: ASCII letters, digits and all bytes of characters beyond ASCII make up words.
WORD_BYTE = np.array([chr(b).isalnum() or b >= 0x80 for b in range(256)])


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Of each word: hash, text (row) and position in the text; ``first`` word of each text, n + 1."""

    hashes: np.ndarray
    rows: np.ndarray
    first: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """The lower-cased words of all texts."""
    data, offsets = bytes_of(pc.utf8_lower(texts))
    inside = np.concatenate([[False], WORD_BYTE[data], [False]])
    cut = np.zeros(len(data) + 2, bool)
    cut[offsets + 1] = True  # texts stand end to end: a word ends where its text does
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[1:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[2:])) + 1
    with np.errstate(over="ignore"):
        powers = np.full(len(data) + 1, np.uint64(BASE))
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], dtype=np.uint64)])
        back = np.full(len(data) + 1, np.uint64(INVERSE))
        back[0] = 1
        np.cumprod(back, out=back)
        hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    rows = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(rows, np.arange(len(texts) + 1))
    return Words(hashes, rows, first)
