"""Fill-in-middle transformation with a learned rank index.

A text is cut into units, by default code points, and rearranged so that its middle comes last. Where
the unit of a rank begins is found by a learned index over all boundary offsets, the end included: the
offsets, as a function of the rank, are covered by straight segments whose error is at most ``BOUND``
bytes, and the residual of every boundary is stored in one byte beside them. A cut is predicted by its
segment and then corrected by its residual, which gives the exact offset. Segments are fitted to all
texts of a batch together: each begins as one segment, and those beyond the bound are halved until all
are within it. A long text is indexed in stretches of ``STRETCH`` bytes, so that beside the text only
the residuals, a byte a unit, and the segments are held.

Cuts come from the hash of ``doc_id`` (``1:`` and the decimal id; a null id counts as empty), so they
are the same on every run. A text that is empty, contains one of the marks, or falls into the plain
share stays as it is. Null texts count as empty, repeated rows each give a row, and columns other than
``doc_id`` and ``text`` are not read. ``restore`` gives the text back from output and form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crawlflow.llm.common import SLICE_BYTES, lean, slices, whole_texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
#: Largest distance of a boundary from its segment, so that a residual takes one byte.
BOUND = 127
STRETCH = SLICE_BYTES


def code_points(data: np.ndarray) -> np.ndarray:
    """Offsets at which a code point begins in UTF-8 bytes."""
    return np.flatnonzero((data & 0xC0) != 0x80)


@dataclass
class RankIndex:
    """Segments over ranks: first rank, offset there and slope; a residual for each rank."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residuals: np.ndarray

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[at] + np.rint(self.slope[at] * (ranks - self.first[at])).astype(np.int64)

    def __call__(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offset of each rank."""
        return self.predict(ranks) + self.residuals[ranks]


def fit(offsets: np.ndarray, starts: np.ndarray) -> RankIndex:
    """The index of increasing ``offsets``; a segment begins at each of ``starts`` (the first is 0) at least."""
    total = len(offsets)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    residuals = np.empty(total, np.int8)
    first, stop = starts, np.concatenate([starts[1:], [total]])
    while len(first):
        size = stop - first
        rise = offsets[stop - 1] - offsets[first]
        slope = rise / np.maximum(size - 1, 1)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        ranks = np.repeat(first, size) + within
        error = offsets[ranks] - np.repeat(offsets[first], size) - np.rint(np.repeat(slope, size) * within).astype(np.int64)
        worst = np.maximum.reduceat(np.abs(error), np.cumsum(size) - size)
        good = worst <= BOUND
        inside = np.repeat(good, size)
        residuals[ranks[inside]] = error[inside]
        done.append((first[good], slope[good]))
        half = first[~good] + size[~good] // 2
        first, stop = np.concatenate([first[~good], half]), np.concatenate([half, stop[~good]])
    first, slope = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(first)
    return RankIndex(first[order], offsets[first[order]], slope[order], residuals)


def join(parts: list[tuple[RankIndex, int, int]]) -> RankIndex:
    """One index of stretches, each with its first rank and its first offset."""
    return RankIndex(
        np.concatenate([i.first + rank for i, rank, _ in parts]),
        np.concatenate([i.base + at for i, _, at in parts]),
        np.concatenate([i.slope for i, _, _ in parts]),
        np.concatenate([i.residuals for i, _, _ in parts]),
    )


def index_texts(
    data: np.ndarray, begins: np.ndarray, units: Callable[[np.ndarray], np.ndarray] = code_points, stretch: int = STRETCH
) -> tuple[RankIndex, np.ndarray]:
    """The index of all units of texts that lie on end, and the rank of each text's first unit.

    ``begins`` has n + 1 offsets. The end of a text is the beginning of the next one. ``units`` gives the
    offsets of units in bytes that begin with one.
    """
    if begins[-1] <= stretch:
        offsets = np.concatenate([units(data), [len(data)]]) if len(data) else np.zeros(1, np.int64)
        first = np.searchsorted(offsets, begins)
        return fit(offsets, np.unique(first)), first
    parts, ranks, rank, start = [], [0], 0, 0
    inner = begins[1:]
    while start < len(data):
        stop = min(len(data), start + stretch)
        offsets = units(data[start:stop])
        known = inner[(inner > start) & (inner <= stop)] - start
        if len(offsets):
            firsts = np.searchsorted(offsets, known)
            parts.append((fit(offsets, np.unique(np.concatenate([[0], firsts[firsts < len(offsets)]]))), rank, start))
            ranks += (rank + firsts).tolist()
        else:
            ranks += [rank] * len(known)
        rank, start = rank + len(offsets), stop
    parts.append((fit(np.zeros(1, np.int64), np.zeros(1, np.int64)), rank, len(data)))
    # Empty texts at the very beginning are not among the inner offsets after 0.
    return join(parts), np.concatenate([np.zeros(len(begins) - len(ranks), np.int64), np.array(ranks)])


CUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            texts = part.column("text")
            size = texts.cast(pa.binary())
            spelled = [s.as_buffer() for s in size]
            begins = np.concatenate([[0], np.cumsum([len(s) for s in spelled], dtype=np.int64)])
            joined = b"".join(spelled)
            index, first = index_texts(np.frombuffer(joined, np.uint8), begins)
            n = np.diff(first)
            h1, h2 = (part.column(h).to_numpy() for h in ("h1", "h2"))
            one, two = h1 % (n + 1), h2 % (n + 1)
            low, high = np.minimum(one, two), np.maximum(one, two)
            cuts = index(first[:-1] + low), index(first[:-1] + high)
            forms = part.column("form").to_pylist()
            moved = np.array([f != "plain" for f in forms], bool)
            outputs = []
            for k, form in enumerate(forms):
                a, p, m, z = begins[k], cuts[0][k], cuts[1][k], begins[k + 1]
                prefix, middle, suffix = joined[a:p], joined[p:m], joined[m:z]
                if form == "plain":
                    outputs.append(joined[a:z])
                elif form == "spm":
                    outputs.append(b"".join([SUFFIX.encode(), suffix, PREFIX.encode(), prefix, MIDDLE.encode(), middle]))
                else:
                    outputs.append(b"".join([PREFIX.encode(), prefix, SUFFIX.encode(), suffix, MIDDLE.encode(), middle]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(n, pa.int64()), part.column("form"),
                    pa.array(low, pa.int64(), mask=~moved), pa.array(high - low, pa.int64(), mask=~moved),
                    pa.array(outputs, pa.binary()).cast(pa.string()),
                ],
                [f.split()[0] for f in CUT.split(", ")],
            )


def fill_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = lambda k: F.conv(F.substring("_digest", 8 * k - 7, 8), 16, 10).cast("long")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (h(3) % 100 >= PLAIN_FROM)
    rows = whole_texts(docs).withColumn("_digest", digest)
    drawn = rows.select(
        "doc_id", "text", h(1).alias("h1"), h(2).alias("h2"),
        F.when(plain, "plain").when(h(4) % 100 < SPM_BELOW, "spm").otherwise("psm").alias("form"),
    )
    return drawn.mapInArrow(lean(rearrange), CUT)


def restore(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that gave ``output``. Other than in plain outputs, each mark stands there once."""
    form = F.col(form) if isinstance(form, str) else form
    output = F.col(output) if isinstance(output, str) else output
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    at = lambda *order: F.concat(*(F.get(parts, F.lit(k)) for k in order))
    return F.when(form == "psm", at(1, 3, 2)).when(form == "spm", at(2, 3, 1)).otherwise(output)
