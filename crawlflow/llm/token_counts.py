"""Token counts by overlap resynchronisation.

A text of up to ``chunk_chars`` is counted at once. A longer one is cut: near every multiple of
``chunk_chars`` a *stable* position is looked for in an overlap, and the overlap is widened until
one is found. A position is proven stable if no piece of the vocabulary occurs across it: merging
only ever yields pieces, so the encodings of any two chunks that show its surroundings, and that of
the whole text, have a token boundary there. The chunks, each with the overlap on both sides, are
encoded with offsets as rows of their own, so that one giant document keeps many tasks busy; each
keeps the tokens between its two splice positions. Where no stable position follows before the end
of the text, the rest is one chunk. A chunk whose encoding shows no boundary at a splice position
would contradict the proof and raises an error instead of giving a wrong count.

Null texts count as empty ones, empty texts have no tokens, repeated rows each give a row, and
columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from crawlflow.llm.common import whole_texts

MODEL = "piece_bpe_32k.model"
CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 256
TOKEN_LIMIT = 4096
SPACE = "▁"
#: Distinct space-led stretches whose counts a task keeps; the memo is emptied beyond.
MEMO = 200_000


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def vocabulary(path: str) -> tuple[frozenset[str], int]:
    """The pieces that a merge can yield, and the length of the longest."""
    model = processor(path)
    ids = range(model.get_piece_size())
    pieces = frozenset(
        model.id_to_piece(i)
        for i in ids
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    )
    return pieces, max(map(len, pieces))


class StretchCounter(dict):
    """Tokens of a space-led stretch without its first space. No piece has a space after other
    characters, so that stretches are encoded independently of each other."""

    def __init__(self, path: str):
        super().__init__()
        self.model = processor(path)
        pieces, _ = vocabulary(path)
        self.independent = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def __missing__(self, stretch: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        n = len(self.model.encode(stretch, num_threads=1)) if stretch else 1
        self[stretch] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.independent or SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            return len(self.model.encode(text, num_threads=1))
        return sum(map(self.__getitem__, text.split(" ")))


def stable(text: str, at: int, pieces: frozenset[str], longest: int) -> bool:
    """Whether no piece occurs across position ``at`` of the text (spaces written as in pieces)."""
    return not any(
        text[a:b] in pieces
        for b in range(at + 1, min(len(text), at + longest - 1) + 1)
        for a in range(at - 1, max(-1, b - longest - 1), -1)
    )


def splices(text: str, path: str, chunk: int, overlap: int) -> list[int]:
    """Increasing stable positions, the first being 0 and the last the text's length."""
    pieces, longest = vocabulary(path)
    shown = text.replace(" ", SPACE)
    found = [0]
    for nominal in range(chunk, len(text), chunk):
        if nominal <= found[-1]:
            continue
        seen, width, at = nominal, overlap, None
        while at is None and seen < len(text):
            stop = min(len(text), nominal + width)
            at = next((p for p in range(seen, stop) if stable(shown, p, pieces, longest)), None)
            seen, width = stop, 2 * width
        if at is None:
            break
        found.append(at)
    return [*found, len(text)]


PART = "row_id long, doc_id long, part int, n_bytes long, n_tokens long, chunk string, lead int, core int"
COUNT = "row_id long, doc_id long, n_bytes long, n_tokens long"


def cut(batches: Iterator[pa.RecordBatch], path: str, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Short texts: their count. Long texts: chunks with overlaps on both sides, sized in bytes."""
    memo = StretchCounter(path)
    names, types = [f.split()[0] for f in PART.split(", ")], [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 2 + [pa.string()] + [pa.int32()] * 2
    overlap = max(overlap, vocabulary(path)[1])
    for batch in batches:
        rows = []
        for row_id, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row_id", "doc_id", "text")), strict=True):
            n_bytes = len(text.encode())
            if len(text) <= chunk:
                rows.append((row_id, doc_id, 0, n_bytes, memo.count(text), None, 0, 0))
                continue
            at = splices(text, path, chunk, overlap)
            for k, (a, b) in enumerate(zip(at, at[1:])):
                lead, core = text[max(0, a - overlap) : a], text[a:b]
                piece = lead + core + text[b : b + overlap]
                rows.append((row_id, doc_id, k, 0 if k else n_bytes, 0, piece, len(lead.encode()), len(core.encode())))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def tokens_between(text: str, first: int, last: int, path: str) -> int:
    """Tokens from byte ``first`` to byte ``last`` of the text, both being token boundaries."""
    found = processor(path).encode(text, return_type="proto").pieces
    starts = [p.begin for p in found]
    if first and first not in starts or last < len(text.encode()) and last not in starts:
        raise ValueError("a splice position is no token boundary")
    whole = last == len(text.encode())
    # The space put before a text may be a token of its own; it belongs to the first chunk.
    return sum((first <= b) and (b < last or whole) for b in starts)


def count_chunks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [
            n if text is None else tokens_between(text, lead, lead + core, path)
            for n, text, lead, core in zip(*(batch.column(c).to_pylist() for c in ("n_tokens", "chunk", "lead", "core")), strict=True)
        ]
        kept = [batch.column(c) for c in ("row_id", "doc_id", "n_bytes")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], ["row_id", "doc_id", "n_bytes", "n_tokens"])


def token_counts(
    docs: DataFrame,
    *,
    model: str | None = None,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row; ``model`` is the path of a sentencepiece file."""
    path = model or model_path()
    # Tells repeated rows apart; the same for a task that runs again.
    rows = whole_texts(docs).withColumn("row_id", F.monotonically_increasing_id())
    parts = rows.mapInArrow(lambda it: cut(it, path, chunk_chars, overlap_chars), PART)
    counted = parts.repartition("row_id", "part").mapInArrow(lambda it: count_chunks(it, path), COUNT)
    return (
        counted.groupBy("row_id")
        .agg(F.first("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
        .drop("row_id")
    )
