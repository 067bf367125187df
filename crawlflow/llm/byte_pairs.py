"""Byte-level BPE encoding and decoding with length-bucketed padded matrices.

A text is split by ``public_tokenizers.PATTERN``; each match is encoded alone. Distinct matches of a
run of texts that the task's memo does not hold are put, as bytes, into matrices of rows of similar
length, padded at the end. In each round every row merges its leftmost pair of least rank: one more
column moves up behind the merge, the two pairs beside it get new ranks, and all others keep theirs.
The rank of a pair is looked up in an open-addressed hash table of all pairs of tokens that make up a
token. Rows without a pair left are written out and leave the matrix; columns that no row needs any
more leave with them.

A match of more than ``WIDE`` bytes is first cut where two bytes meet that no token holds side by side,
which nothing can merge across. A stretch that is still longer is a row of its own. There, a round
merges as many of the row's next merges as are sure to follow each other: all places of the least rank,
from the left, up to the first that creates a pair of lower rank. That is the same sequence of merges.

As in the rank file's library, a match that is itself a token is that token. Ids are ranks. Null
texts count as empty, and an empty text has no ids. Repeated rows each give a row; columns other than
``doc_id`` and ``text`` are not read. A very long text is read match by match, so that beside its ids
only ``STREAM`` matches are held. ``decode`` turns null ids into no bytes and refuses unknown ids.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from crawlflow.llm.common import SLICE_BYTES, lean, slices, whole_texts

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Longer matches are cut or become rows of their own.
WIDE = 256
#: Widths of the matrices, and how many cells one may have.
WIDTHS = (2, 4, 8, 12, 16, 24, 32, 64, 128, WIDE)
CELLS = 1 << 18
#: Distinct matches whose ids a task keeps; the memo is emptied beyond.
MEMO = 120_000
#: Matches of a text that are looked at together; texts of more characters are read match by match.
STREAM = 1 << 17
STREAM_CHARS = 1 << 20
# Letters and numbers of the Unicode version of `regex` that the rank file's library does not know as such.
NEWER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F "
    "12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF "
    "1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E "
    "2CEA2-2CEAD 323B0-33479 3D000-3FC3F "
).split()
#: Characters below are told apart by spelled-out classes; every Unicode version knows them alike.
PLAIN = 0x530
NONE = np.iinfo(np.int32).max
_EMPTY = np.int64(-1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def splitters() -> tuple[re.Pattern, regex.Pattern, regex.Pattern, frozenset[str]]:
    """What splits texts of characters below ``PLAIN``; of any; of any with ``NEWER`` as neither letters
    nor numbers; and those. The first gives the same matches in less time, with classes spelled out."""
    import public_tokenizers

    pattern = public_tokenizers.PATTERN
    of = {kind: "".join(rf"\u{c:04x}" for c in range(PLAIN) if unicodedata.category(chr(c))[0] == kind) for kind in "LN"}
    space = r"\t-\r \x85\xa0"
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{of['L']}{of['N']}]").replace(r"(?!\S)", f"(?![^{space}])")
    plain = plain.replace(r"\p{L}", f"[{of['L']}]").replace(r"\p{N}", f"[{of['N']}]").replace(r"\s", f"[{space}]")
    newer = "[" + "".join("-".join(f"\\U{int(c, 16):08X}" for c in r.split("-")) for r in NEWER) + "]"
    older = pattern.replace(r"\p{L}", rf"[\p{{L}}--{newer}]").replace(r"\p{N}", rf"[\p{{N}}--{newer}]")
    ends = [[int(c, 16) for c in r.split("-")] for r in NEWER]
    named = frozenset(chr(c) for e in ends for c in range(e[0], e[-1] + 1))
    return re.compile(plain), regex.compile(pattern), regex.compile("(?V1)" + older), named


def splitter(text: str) -> re.Pattern | regex.Pattern:
    """What splits ``text`` as the rank file's library does."""
    plain, pattern, older, named = splitters()
    if text.isascii() or max(text) < chr(PLAIN):
        return plain
    return pattern if named.isdisjoint(text) else older


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + size]`` on end."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - before, sizes) + np.arange(total)]


class PairRanks:
    """Ranks of pairs of tokens, by open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        keys = left.astype(np.int64) << 32 | right
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.ranks = np.full(1 << bits, _EMPTY), np.full(1 << bits, NONE, np.int32)
        slot = self._home(keys)
        todo = np.arange(len(keys))
        while len(todo):  # each round places one key in every free slot that is asked for
            free = todo[self.keys[slot[todo]] == _EMPTY]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.ranks[slot[placed]] = keys[placed], rank[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            taken = todo[self.keys[slot[todo]] != _EMPTY]
            slot[taken] = (slot[taken] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _FACTOR >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` if it is no token. A negative token is padding."""
        keys = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        slot = self._home(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.ranks[slot], NONE)
        on = np.flatnonzero((held != keys) & (held != _EMPTY))
        while len(on):
            slot[on] = (slot[on] + 1) & self.mask
            held = self.keys[slot[on]]
            hit = held == keys[on]
            out[on[hit]] = self.ranks[slot[on[hit]]]
            on = on[~hit & (held != _EMPTY)]
        out[(left < 0) | (right < 0)] = NONE
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class Spellings:
    """The bytes of every id; an id that is in no file has none."""

    def __init__(self, ranks: dict[bytes, int]):
        spelled = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            spelled[rank] = token
        self.sizes = np.array([len(t) for t in spelled], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)


class Vocabulary(Spellings):
    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        super().__init__(self.ranks)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        splits = ((token[:k], token[k:], rank) for token, rank in self.ranks.items() for k in range(1, len(token)))
        known = array("q")
        for left, right, rank in splits:
            if left in self.ranks and right in self.ranks:
                known.extend((self.ranks[left], self.ranks[right], rank))
        self.pairs = PairRanks(*np.frombuffer(known, np.int64).reshape(-1, 3).T)
        inside = np.ones(max(len(self.bytes) - 1, 0), bool)
        inside[self.starts[self.starts > 0] - 1] = False  # the last byte of a token and the first of the next
        self.beside = np.zeros(1 << 16, bool)
        self.beside[(self.bytes[:-1].astype(np.int64) << 8 | self.bytes[1:])[inside]] = True

    def matrix(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> list[np.ndarray]:
        """Ids of rows of 2 to ``width`` bytes of ``data``."""
        found: list[np.ndarray] = [np.empty(0, np.int32)] * len(sizes)
        column = np.arange(width)
        valid = column < sizes[:, None]
        tokens = np.full((len(sizes), width + 1), -1, np.int32)  # the last column stays padding
        tokens[:, :-1][valid] = self.single[ragged(data, starts, sizes)]
        ranks = np.full((len(sizes), width + 1), NONE, np.int32)
        ranks[:, :-1] = self.pairs(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(-1, width)
        rows, sizes = np.arange(len(sizes)), sizes.copy()
        while len(rows):
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            over = least == NONE
            if over.any():
                for k in np.flatnonzero(over):
                    found[rows[k]] = tokens[k, : sizes[k]].copy()
                width = int(sizes[~over].max(initial=0))
                stay = ~over
                rows, sizes, at, least = rows[stay], sizes[stay], at[stay], least[stay]
                tokens, ranks = tokens[stay, : width + 1], ranks[stay, : width + 1]
                if not len(rows):
                    break
            every = np.arange(len(rows))
            # What stands behind the merged pair moves up by one.
            source = np.minimum(np.arange(width + 1) + (np.arange(width + 1) > at[:, None]), width)
            tokens, ranks = np.take_along_axis(tokens, source, 1), np.take_along_axis(ranks, source, 1)
            tokens[:, -1], ranks[:, -1] = -1, NONE
            sizes -= 1
            tokens[every, at] = least
            ranks[every, at] = self.pairs(least, tokens[every, at + 1])
            left = np.flatnonzero(at)
            ranks[left, at[left] - 1] = self.pairs(tokens[left, at[left] - 1], least[left])
        return found

    def row(self, data: np.ndarray) -> np.ndarray:
        """Ids of one long row: each round makes all merges of the least rank that are sure to be next."""
        tokens = self.single[data]
        ranks = self.pairs(tokens[:-1], tokens[1:])
        while len(ranks) and (least := int(ranks.min())) != NONE:
            at = np.flatnonzero(ranks == least)
            run = np.cumsum(np.diff(at, prepend=-2) > 1)  # pairs that overlap: every other one, from the left
            first = np.searchsorted(run, run)
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            padded = np.concatenate([tokens, np.array([-1, -1], np.int32)])
            before = np.where(np.diff(at, prepend=-9) == 2, least, padded[at - 1])  # at 0 this is padding
            merged = np.full(len(at), least, np.int32)
            lower = np.minimum(self.pairs(before, merged), self.pairs(merged, padded[at + 2])) < least
            if lower.any():
                at = at[: int(lower.argmax()) + 1]
            tokens[at] = least
            keep = np.ones(len(tokens), bool)
            keep[at + 1] = False
            # The pair behind a merge takes over the place of its second token.
            new = np.concatenate([ranks, [NONE]])
            tokens, new = tokens[keep], new[keep]
            here = at - np.arange(len(at))
            changed = np.concatenate([here[here + 1 < len(tokens)], here[here > 0] - 1])
            new[changed] = self.pairs(tokens[changed], tokens[changed + 1])
            ranks = new[: len(tokens) - 1]
        return tokens

    def pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        found: list = [None] * len(pieces)
        short, long = [], []
        for k, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None or not piece:
                found[k] = np.array([] if rank is None else [rank], np.int32)
            elif len(piece) <= WIDE:
                short.append(k)
            else:
                long.append(k)
        for k, ids in zip(short, self.buckets([pieces[k] for k in short]), strict=True):
            found[k] = ids
        for k in long:
            data = np.frombuffer(pieces[k], np.uint8)
            joint = self.beside[data[:-1].astype(np.int64) << 8 | data[1:]]
            ends = np.concatenate([np.flatnonzero(~joint) + 1, [len(data)]])
            starts = np.concatenate([[0], ends[:-1]])
            wide = ends - starts > WIDE
            parts: list = [None] * len(ends)
            small = np.flatnonzero(~wide)
            for j, ids in zip(small, self.buckets([data[a:b].tobytes() for a, b in zip(starts[small], ends[small], strict=True)]), strict=True):
                parts[j] = ids
            for j in np.flatnonzero(wide):
                parts[j] = self.row(data[starts[j] : ends[j]])
            found[k] = np.concatenate(parts)
        return found

    def buckets(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of at most ``WIDE`` bytes, by rounds alone."""
        found: list = [None] * len(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        for k in np.flatnonzero(sizes == 1):
            found[k] = self.single[pieces[k][0] : pieces[k][0] + 1]
        least = 1
        for width in WIDTHS:
            fits = np.flatnonzero((sizes > least) & (sizes <= width))
            least = width
            for block in np.array_split(fits, -(-len(fits) * width // CELLS)) if len(fits) else ():
                data = np.frombuffer(b"".join(pieces[k] for k in block), np.uint8)
                size = sizes[block]
                for k, ids in zip(block, self.matrix(data, np.cumsum(size) - size, size, width), strict=True):
                    found[k] = ids
        return found


class Encoder:
    """Ids of texts; remembers those of recent matches."""

    def __init__(self, vocabulary: Vocabulary, memo: int = MEMO):
        self.vocabulary, self.memo = vocabulary, memo
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids, self.starts, self.sizes = (np.empty(0, t) for t in (np.int32, np.int64, np.int64))

    def learn(self, matches: Iterable[str]) -> None:
        fresh = [m for m in matches if m not in self.slots]
        if not fresh:
            return
        found = self.vocabulary.pieces([m.encode() for m in fresh])
        sizes = np.array([len(f) for f in found], np.int64)
        self.slots.update(zip(fresh, range(len(self.starts), len(self.starts) + len(fresh))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, *found])

    def matches(self, found: list[str], ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all matches on end, and how many there are up to each of ``ends`` matches."""
        if len(self.slots) > self.memo:
            self.forget()
        self.learn(set(found))
        slots = np.fromiter(map(self.slots.__getitem__, found), np.int64, len(found))
        sizes = self.sizes[slots]
        before = np.concatenate([[0], np.cumsum(sizes)])
        return ragged(self.ids, self.starts[slots], sizes), before[ends]

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and where each ends."""
        if len(texts) == 1 and len(texts[0]) > STREAM_CHARS:
            rest = (m.group() for m in splitter(texts[0]).finditer(texts[0]))
            parts = []
            while block := list(islice(rest, STREAM)):
                parts.append(self.matches(block, [len(block)])[0])
            ids = np.concatenate(parts)
            return ids, np.array([len(ids)])
        found, ends = [], []
        for text in texts:
            found += splitter(text).findall(text)
            ends.append(len(found))
        return self.matches(found, ends)


@cache
def spellings(path: str) -> Spellings:
    return Spellings(read_ranks(path))


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, *, ranks: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; ``ranks`` is the path of a rank file."""
    path = ranks or ranks_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))
        for batch in batches:
            pa.default_memory_pool().release_unused()
            for part in slices(batch):
                ids, ends = encoder.texts(part.column("text").to_pylist())
                offsets = np.concatenate([[0], ends])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), lists], ["doc_id", "n_tokens", "ids"]
                )

    return whole_texts(docs).mapInArrow(lean(run), "doc_id long, n_tokens long, ids array<int>")


def runs(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` ids; a longer list is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()


def decode(encoded: DataFrame, *, ranks: str | None = None) -> DataFrame:
    """``encoded`` with ``bytes`` in place of ``ids``; its other columns are kept."""
    path = ranks or ranks_path()
    kept = [c for c in encoded.columns if c not in ("ids", "bytes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = spellings(path)
        for batch in (part for whole in batches for part in runs(whole)):
            lists = batch.column("ids")
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            if len(ids) and (ids.min() < 0 or ids.max() >= len(known.sizes) or not known.sizes[ids].all()):
                raise ValueError("an id is not in the rank file")
            size = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
            sizes = known.sizes[ids]
            data = ragged(known.bytes, known.starts[ids], sizes)
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(size)])]
            spelled = pa.Array.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data.tobytes())]
            )
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), spelled.cast(pa.binary())], [*kept, "bytes"])

    schema = encoded.select(*kept).withColumn("bytes", F.lit(b"")).schema
    return encoded.mapInArrow(lean(run), schema)


def ids_text(ids: str | Column) -> Column:
    """Decimal ids joined by commas."""
    return F.concat_ws(",", F.col(ids).cast("array<string>") if isinstance(ids, str) else ids.cast("array<string>"))
