"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is cut into the sequence of vocabulary pieces with the largest sum of scores (Viterbi). Ties
prefer, from the end, the piece that begins first. Scores are the file's own; a character without a
piece is spelled in byte pieces at ``UNKNOWN`` below the worst score. Spaces are written as in
pieces and one is put before a text; ``decode`` undoes this, so encoding then decoding gives the
text back (with a literal U+2581 as a space, which the format cannot tell apart).

Giant documents are cut into chunks, which may fall inside a piece. The state at a boundary is the
number of characters by which a piece reaches over it. Each chunk gives a matrix over (state at its
start, state at its end): the best score in between, minus infinity if there is none. Matrices
combine in the max-plus semiring, associatively; the scan gives every chunk the best score of each
state at its start. From these a chunk finds, alone, which start state each end state comes from;
composing these maps from the end gives every chunk its true end state, and each chunk is traced
back independently. The result is that of one pass over the whole text, ties included, as scores
are whole numbers.

No piece has a space after another character or mixes letters with others, so every path passes every
place between them: stretches between are memoized, and only the first and last stretch of a chunk
depend on its states. (Where a vocabulary's pieces are not like that, stretches are whole words; where
they span words too, it is worked on character by character.)

Null texts count as empty, which encode to nothing. Repeated rows each give a row; columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crawlflow.llm.common import lean, whole_texts
from crawlflow.llm.token_counts import SPACE, model_path, processor
from crawlflow.session import materialize

CHUNK_CHARS = 1 << 15
UNKNOWN = 10.0
MEMO = 200_000
NEVER = float("-inf")
#: Stretches, finest first: spaces then letters or then other characters; spaces then a word. Where
#: one ends depends on the two characters there alone. The first kind is used that cuts no piece.
CUTS = (
    re.compile(f"{SPACE}*(?:[^\\W\\d_]+|(?:[^\\w{SPACE}]|[\\d_])+)|{SPACE}+"),
    re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+"),
)


class Lattice:
    """The pieces and scores of a model file, and best paths through texts."""

    def __init__(self, path: str):
        model = processor(path)
        ids = range(model.get_piece_size())
        self.pieces = {
            model.id_to_piece(i): (i, model.get_score(i))
            for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        }
        self.spelling = {i: bytes([int(model.id_to_piece(i)[3:5], 16)]) for i in ids if model.is_byte(i)}
        self.byte_ids = {b[0]: i for i, b in self.spelling.items()}
        self.spelling |= {i: p.encode() for p, (i, _) in self.pieces.items()}
        self.longest = max(map(len, self.pieces))
        self.unknown = min(s for _, s in self.pieces.values() if s > -1e8) - UNKNOWN
        # By character: what may follow, and the score of what was read (minus infinity: no piece yet).
        self.trie: dict = {}
        leaf: dict = {}
        for piece in sorted(self.pieces, key=len, reverse=True):
            node = self.trie
            for c in piece[:-1]:
                after, score = node.get(c, (leaf, NEVER))
                if after is leaf:
                    after = {}
                    node[c] = after, score
                node = after
            node[piece[-1]] = node.get(piece[-1], (leaf,))[0], self.pieces[piece][1]
        for c, (after, score) in self.trie.items():
            self.trie[c] = after, self.unknown if score == NEVER else score
        self.alone = leaf, self.unknown
        self.cut = next((c for c in CUTS if all(map(c.fullmatch, self.pieces))), None)
        # Two generations: the older one goes when the newer one is full.
        self.memo: dict[str, tuple[float, bytes]] = {}
        self.older: dict[str, tuple[float, bytes]] = {}

    def ids(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        return [found[0]] if found else [self.byte_ids[b] for b in piece.encode()]

    def forward(self, text: str, seeds: dict[int, float], starts: int) -> tuple[list[float], list[int], list[int]]:
        """Best score of each position, the position before it on the best path (-1: a seed) and
        the seed it comes from. Pieces begin before ``starts``."""
        size, roots = len(text) + 1, self.trie.get
        best, before, seed = [NEVER] * size, [-1] * size, list(range(size))
        for p, score in seeds.items():
            if p < size:
                best[p] = score
        for a in range(min(starts, size - 1)):
            base = best[a]
            if base == NEVER:
                continue
            after, score = roots(text[a], self.alone)
            p = a + 1
            while True:
                if base + score > best[p]:
                    best[p], before[p], seed[p] = base + score, a, seed[a]
                found = after.get(text[p]) if p < size - 1 else None
                if found is None:
                    break
                after, score = found
                p += 1
        return best, before, seed

    def trace(self, text: str, before: list[int], end: int) -> list[int]:
        found: list[int] = []
        while end > 0 and before[end] >= 0:
            piece = self.pieces.get(text[before[end] : end])
            if piece:
                found.append(piece[0])
            else:
                found += reversed(self.ids(text[before[end] : end]))
            end = before[end]
        return found[::-1]

    def stretch(self, text: str) -> tuple[float, bytes]:
        """Score and ids of a stretch that paths enter at its start and leave at its end."""
        found = self.memo.get(text)
        if found is None:
            found = self.older.get(text) or self.shortest(text)
            if len(self.memo) >= MEMO:
                self.older, self.memo = self.memo, {}
            self.memo[text] = found
        return found

    def shortest(self, text: str) -> tuple[float, bytes]:
        """``forward`` and ``trace`` of a stretch, for which one seed and no origins are needed."""
        n, roots, alone = len(text), self.trie.get, self.alone
        best, before = [NEVER] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for a in range(n):
            base, p = best[a], a + 1
            after, score = roots(text[a], alone)
            score += base
            if score > best[p]:
                best[p], before[p] = score, a
            for c in text[p:]:
                found = after.get(c)
                if found is None:
                    break
                after, score = found
                p += 1
                score += base
                if score > best[p]:
                    best[p], before[p] = score, a
        # Packed, so that ids of a text are joined at once and the garbage collector has less to visit.
        return best[n], array("i", self.trace(text, before, n)).tobytes()

    def turns(self, text: str, first: int, last: int) -> list[int]:
        """Ends of stretches in ``first .. last``: positions that every path passes."""
        return [m.end() for m in self.cut.finditer(text) if first <= m.end() <= last] if self.cut else []

    def packed(self, text: str) -> tuple[float, bytes]:
        """Score and packed ids of a whole text that has not been prepared."""
        if not text:
            return 0.0, b""
        shown, known = prepared(text), self.memo.get
        score, ids = 0.0, []
        for x in self.cut.findall(shown) if self.cut else [shown]:
            part = known(x) or self.stretch(x)
            score += part[0]
            ids.append(part[1])
        return score, b"".join(ids)

    def encode(self, text: str) -> tuple[float, list[int]]:
        """``packed`` with the ids as a list."""
        score, ids = self.packed(text)
        return score, np.frombuffer(ids, np.int32).tolist()

    def through(self, text: str, n: int, seeds: dict[int, float]) -> Passage:
        """Best paths through a chunk: ``text`` is the chunk of ``n`` characters and a lookahead."""
        turns = self.turns(text, self.longest, n - 1)
        return Passage(self, text, n, seeds, turns)

    def matrix(self, text: str, n: int) -> np.ndarray:
        """Start state by end state: the best score from one to the other."""
        size = self.longest
        out = np.full((size, size), NEVER)
        inner = None
        for e in range(min(size, n)):
            p = Passage(self, text, n, {e: 0.0}, self.turns(text, size, n - 1), inner)
            inner = p.inner
            out[e] = [p.score(x) for x in range(size)]
        return out


class Passage:
    """Head, inner stretches and tail of a chunk; only head and tail depend on the states."""

    def __init__(self, lattice: Lattice, text: str, n: int, seeds: dict[int, float], turns: list[int], inner=None):
        self.lattice, self.text, self.n = lattice, text, n
        self.turns = turns
        self.head_end = turns[0] if turns else None
        head = text[: self.head_end] if turns else text
        self.head = lattice.forward(head, seeds, n)
        if turns:
            if inner is None:
                parts = [lattice.stretch(text[a:b]) for a, b in zip(turns, turns[1:])]
                tail = text[turns[-1] : n + lattice.longest - 1]
                inner = parts, lattice.forward(tail, {0: 0.0}, n - turns[-1])
            self.inner = inner
            self.base = self.head[0][-1] + sum(p[0] for p in inner[0])
        else:
            self.inner = None

    def score(self, x: int) -> float:
        if not self.turns:
            return self.head[0][self.n + x] if self.n + x < len(self.head[0]) else NEVER
        best, at = self.inner[1][0], self.n + x - self.turns[-1]
        return self.base + best[at] if at < len(best) else NEVER

    def origin(self, x: int) -> int:
        """The start state from which end state ``x`` is reached best; -1 if it is not reached."""
        if self.score(x) == NEVER:
            return -1
        return self.head[2][-1] if self.turns else self.head[2][self.n + x]

    def ids(self, x: int) -> list[int]:
        if not self.turns:
            return self.lattice.trace(self.text, self.head[1], self.n + x)
        parts, (_, before, _) = self.inner
        out = self.lattice.trace(self.text, self.head[1], self.head_end)
        out += np.frombuffer(b"".join(p[1] for p in parts), np.int32).tolist()
        return out + self.lattice.trace(self.text[self.turns[-1] :], before, self.n + x - self.turns[-1])


def prepared(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


@cache
def lattice(path: str) -> Lattice:
    return Lattice(path)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


ENCODED = "row_id long, doc_id long, score double, ids array<int>"
CHUNKS = "row_id long, doc_id long, part int, n int, chunk string"


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64())}
    names, types = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    for row in zip(*(batch.column(c) for c in names), strict=True):
        yield tuple(x.as_py() for x in row)


def encode_whole(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = lattice(path)

    def encoded(rows: list[tuple]) -> pa.RecordBatch:
        row_ids, doc_ids, scores, ids = zip(*rows) if rows else ((), (), (), ())
        ends = np.cumsum([0, *map(len, ids)]) // 4
        values = pa.array(np.frombuffer(b"".join(ids), np.int32))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        columns = [pa.array(row_ids, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(scores, pa.float64()), lists]
        return pa.RecordBatch.from_arrays(columns, ["row_id", "doc_id", "score", "ids"])

    for batch in batches:
        rows, chars = [], 0
        for row_id, doc_id, text in rows_of(batch, "row_id", "doc_id", "text"):
            rows.append((row_id, doc_id, *model.packed(text)))
            chars += len(text)
            if chars > 1 << 21:
                yield encoded(rows)
                rows, chars = [], 0
        yield encoded(rows)


def cut(batches: Iterator[pa.RecordBatch], path: str, chunk: int) -> Iterator[pa.RecordBatch]:
    """Chunks of ``chunk`` characters or more, each with a lookahead over its end."""
    ahead = lattice(path).longest - 1
    for batch in batches:
        for row_id, doc_id, text in rows_of(batch, "row_id", "doc_id", "text"):
            shown = prepared(text)
            at = [*range(0, len(shown) - chunk + 1, chunk), len(shown)]
            yield batch_of([(row_id, doc_id, k, b - a, shown[a : b + ahead]) for k, (a, b) in enumerate(zip(at, at[1:]))], CHUNKS)


def encode_giants(chunks: DataFrame, path: str) -> DataFrame:
    """``row_id, doc_id, part, score, ids`` of the chunks of giant documents."""
    size = lattice(path).longest
    key = ["row_id", "part"]

    def matrices(batches):
        model = lattice(path)
        for batch in batches:
            for r in batch.to_pylist():
                yield batch_of([(r["row_id"], r["part"], model.matrix(r["chunk"], r["n"]).ravel().tolist())], "row_id long, part int, matrix array<double>")

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        state = np.full((1, size), NEVER)
        state[0, 0] = 0.0
        states = []
        for flat in pdf["matrix"]:
            states.append(state[0].tolist())
            state = combine(state, np.asarray(flat).reshape(size, size))
        return pd.DataFrame({"row_id": pdf["row_id"], "part": pdf["part"], "start": states})

    def seeds(r) -> dict[int, float]:
        return {e: s for e, s in enumerate(r["start"]) if s > NEVER}

    def origins(batches):
        model = lattice(path)
        for batch in batches:
            for r in batch.to_pylist():
                passage = model.through(r["chunk"], r["n"], seeds(r))
                yield batch_of([(r["row_id"], r["part"], [passage.origin(x) for x in range(size)])], "row_id long, part int, origin array<int>")

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part", ascending=False)
        end, out = 0, []
        for origin in pdf["origin"]:
            out.append(end)
            end = int(origin[end])
        return pd.DataFrame({"row_id": pdf["row_id"], "part": pdf["part"], "stop": out})

    def traced(batches):
        model = lattice(path)
        for batch in batches:
            for r in batch.to_pylist():
                passage = model.through(r["chunk"], r["n"], seeds(r))
                # Scores run on from the document's start, so that the last chunk's is the document's.
                yield batch_of([(r["row_id"], r["doc_id"], r["part"], passage.score(r["stop"]), passage.ids(r["stop"]))], "row_id long, doc_id long, part int, score double, ids array<int>")

    # A document is one cell of at most 2 GB, so its matrices are at most a few dozen MB.
    scanned = chunks.mapInArrow(matrices, "row_id long, part int, matrix array<double>").groupBy("row_id").applyInPandas(scan, "row_id long, part int, start array<double>")
    started = materialize(chunks.join(scanned, key), "chunk_states")
    stops = started.mapInArrow(origins, "row_id long, part int, origin array<int>").groupBy("row_id").applyInPandas(ends, "row_id long, part int, stop int")
    return started.join(stops, key).mapInArrow(traced, "row_id long, doc_id long, part int, score double, ids array<int>")


def encode(docs: DataFrame, *, model: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``row_id, doc_id, ids, score`` of every row; ``row_id`` tells repeated rows apart."""
    path = model or model_path()
    rows = whole_texts(docs).withColumn("row_id", F.monotonically_increasing_id())
    size = max(chunk_chars, 2 * lattice(path).longest)
    giant = F.length("text") >= 2 * size
    short = rows.where(~giant).mapInArrow(lean(lambda it: encode_whole(it, path)), ENCODED)
    chunks = materialize(rows.where(giant).mapInArrow(lambda it: cut(it, path, size), CHUNKS).repartition("row_id", "part"), "chunks")
    parts = encode_giants(chunks, path)
    joined = parts.groupBy("row_id").agg(
        F.first("doc_id").alias("doc_id"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "ids"))), lambda s: s["ids"])).alias("ids"),
        F.max_by("score", "part").alias("score"),
    )
    return short.unionByName(joined.select("row_id", "doc_id", "ids", "score"))


def decoded(model: Lattice, ids: list[int]) -> str:
    text = b"".join(map(model.spelling.__getitem__, ids)).decode(errors="replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def decode(encoded: DataFrame, *, model: str | None = None) -> DataFrame:
    """``row_id, doc_id, n_pieces, score, ids_sha256, text`` of encoded rows."""
    path = model or model_path()
    schema = "row_id long, doc_id long, n_pieces long, score double, ids_sha256 string, text string"

    def run(batches):
        for batch in batches:
            rows, chars = [], 0
            known = lattice(path)
            for r in zip(*(batch.column(c) for c in ("row_id", "doc_id", "score", "ids")), strict=True):
                ids = np.asarray(r[3].values, np.int32)
                text = decoded(known, ids.tolist())
                rows.append((r[0].as_py(), r[1].as_py(), len(ids), r[2].as_py(), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), text))
                chars += len(text)
                if chars > 1 << 21:
                    yield batch_of(rows, schema)
                    rows, chars = [], 0
            yield batch_of(rows, schema)

    return encoded.mapInArrow(lean(run), schema)
