"""Removal of long repeats: every byte covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller ``doc_id``.

Anchors find where such strings can be. The anchor of a string of LENGTH bytes is the place in it
whose ``GRAM`` bytes have the smallest hash (the first such place); equal strings have equal anchors
at the same place. An anchor's *context* is the union of the strings that have it, which follow each
other.

1. Every batch of texts sends each anchor's hash with a digest of its context and its smallest
   document to the bucket of the hash: once per batch, and twice if it has several contexts, so a
   passage in a third of all texts does not fill a bucket.
2. Buckets answer. If all contexts of an anchor are equal, all of it is repeated in every document
   but the smallest. If they differ, each document but the first of a context has all of it
   repeated, and that first one is asked for its context.
3. Contexts of an anchor with several ones are ordered by a suffix array (linear grouping
   construction, ``suffix_array``) over the reversed left and the right sides; neighbouring prefixes
   tell which strings of LENGTH bytes two contexts share, and so which are repeated from a smaller
   document. No task may hold an unbounded group: contexts of an anchor with more than ``GROUP`` are
   cut to pieces of at most seven strings, equal pieces become one, and the suffix array orders those
   that agree in the 44 bytes (or more) all their strings hold. Where more than ``GROUP`` still agree,
   Spark compares them, one row per string; the result is the same.

The documents themselves are shuffled by ``doc_id`` twice: to find contexts and to cut repeats out.

Null texts count as empty. Rows without ``doc_id`` neither lose bytes nor cause others to. Repeated
rows (same id and text) do not remove each other and give equal results. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from crawlflow.llm.common import bytes_of, give_back, lean, slices, whole_texts
from crawlflow.llm.suffix_array import common_prefix, suffix_array
from crawlflow.llm.words import BASE, INVERSE, mix
from crawlflow.session import materialize

LENGTH = 50
GRAM = 24
WINDOW = LENGTH - GRAM + 1
SIDE = LENGTH - GRAM
GROUP = 2048
BUCKET_BYTES = 4 << 20
PART_BYTES, SLICE = 4 << 20, 1 << 18


#: Bits of a place in a batch; a text has fewer than 2 GB.
PLACE = np.uint64((1 << 31) - 1)


def leftmost_least(x: np.ndarray, width: int) -> np.ndarray:
    """Where each run of ``width`` has its smallest value by the upper 33 bits, the first of equal ones; by doubling."""
    least, span = (x & ~PLACE) | np.arange(len(x), dtype=np.uint64), 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return (least & PLACE).astype(np.int64)


def powers_to(n: int) -> list[np.ndarray]:
    """The powers 0 to n of the base and of its inverse."""
    both = [np.full(n + 1, np.uint64(base)) for base in (BASE, INVERSE)]
    for powers in both:
        powers[0] = 1
        with np.errstate(over="ignore"):
            np.cumprod(powers, out=powers)
    return both


class Anchors:
    """Of each anchor in a batch: text, position, bounds of its context, hash and context digest."""

    def __init__(self, texts: pa.Array, powers: list[np.ndarray]):
        data, offsets = bytes_of(texts)
        self.data = data
        empty = np.zeros(0, np.int64)
        self.row, self.at, self.lo, self.hi = empty, empty, empty, empty
        self.hash = self.digest = np.zeros(0, np.uint64)
        self.offsets = offsets
        strings = np.maximum(np.diff(offsets) - LENGTH + 1, 0)  # of each text
        if not strings.any():
            return
        with np.errstate(over="ignore"):
            powers, back = powers if len(data) < len(powers[0]) else powers_to(len(data))  # a text longer than a slice has its own
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
            grams = mix((sums[GRAM:] - sums[:-GRAM]) * back[: len(data) - GRAM + 1])
            before = np.cumsum(strings) - strings
            string = np.repeat(offsets[:-1] - before, strings) + np.arange(strings.sum())  # starts of those in one text
            of = leftmost_least(grams, WINDOW)[string]
            head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))  # no place is in two texts
            last = np.concatenate([head[1:], [len(string)]]) - 1
            self.at, self.lo, self.hi = of[head], string[head], string[last] + LENGTH
            self.row = np.searchsorted(offsets, self.lo, side="right") - 1
            self.hash = grams[self.at]
            whole = mix((sums[self.hi] - sums[self.lo]) * back[self.lo])
            self.digest = mix(whole + (self.at - self.lo).astype(np.uint64), 5)


def packed(x: np.ndarray) -> bytes:
    """Bytes plane by plane: small numbers leave planes of zeros, which compress to nothing."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def unpacked(parts: list[bytes], kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    arrays = [np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(width, -1).T).view(kind).ravel() for p in parts]
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


def classes(hash_: np.ndarray, digest: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order by hash, context and document; in it: heads of contexts, contexts of the hash so far
    (from 0), whether the hash has several, and the context's smallest document."""
    order = np.argsort(hash_, kind="stable")
    h = hash_[order]
    same = h[1:] == h[:-1]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(h) else order
    among = order[tied]  # most hashes occur once: only the others need the order by context and document
    order[tied] = among[np.lexsort((ids[among], digest[among], hash_[among]))]
    h, d, i = hash_[order], digest[order], ids[order]
    new_hash = np.concatenate([[True], h[1:] != h[:-1]])[: len(h)]
    head = np.concatenate([[True], d[1:] != d[:-1]])[: len(h)] | new_hash
    context, group = np.cumsum(head) - 1, np.cumsum(new_hash) - 1
    first_context = context[new_hash][group] if len(h) else context
    nth = context - first_context
    several = (np.bincount(group, head, minlength=1)[group] > 1) if len(h) else head
    return order, head, nth, several, i[head][context] if len(h) else i


REQUEST = "bucket long, kind int, doc_id long, hash binary, digest binary, ids binary"
ANSWER = "doc_id long, kind int, keys binary"
REPEATED, ASKED = 1, 2


def key_of(hash_: np.ndarray, digest: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(hash_, 6) + digest


def per_document(ids: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(ids, kind="stable")
    ids, keys = ids[order], keys[order]
    cut = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])[: len(ids)])
    for a, b in zip(cut, [*cut[1:], len(ids)]):
        yield int(ids[a]), keys[a:b].tobytes()


def requests(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """What batches ask of buckets, and what they know alone already."""
    powers = powers_to(SLICE)
    for batch in batches:
        for part in slices(batch, PART_BYTES):
            found = [(a.hash, a.digest, s.column("doc_id").to_numpy(zero_copy_only=False)[a.row]) for s in slices(part, SLICE) for a in [Anchors(s.column("text"), powers)]]
            hash_, digest, ids = (np.concatenate(x) for x in zip(*found, strict=True))
            digest &= np.uint64(0xFFFFFFFFFF)
            hash_ >>= np.uint64(16)
            order, head, nth, several, first = classes(hash_, digest, ids)
            h, d, i = hash_[order], digest[order], ids[order]
            rows = []
            for kind, which in ((REPEATED, i > first), (ASKED, head & several)):
                for doc, keys in per_document(i[which], key_of(h[which], d[which])):
                    rows.append((hash(doc) % buckets, kind, doc, keys, None, None))
            sent = head & (nth < 2)
            h, d, i = h[sent], d[sent], i[sent]
            bucket = (h * np.uint64(buckets)) >> np.uint64(48) if buckets < 1 << 16 else h % np.uint64(buckets)
            by = np.argsort(bucket, kind="stable")
            h, d, i, bucket = h[by], d[by], i[by], bucket[by].astype(np.int64)
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)])
            for a, b in zip(cut, [*cut[1:], len(bucket)]):
                rows.append((int(bucket[a]), 0, None, packed(h[a:b]), packed(d[a:b]), packed(i[a:b])))
            yield arrow(rows, REQUEST)


def arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    names, types = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def answers(table: pa.Table) -> pa.Table:
    """One bucket: which contexts are repeated, and which are asked for."""
    kind = table.column("kind").to_numpy()
    hashes = table.column("hash").to_pylist()
    docs = table.column("doc_id").to_pylist()
    rows = [(docs[k], int(kind[k]), hashes[k]) for k in np.flatnonzero(kind)]
    asked = np.flatnonzero(kind == 0)
    digests, ids = table.column("digest").to_pylist(), table.column("ids").to_pylist()
    h = unpacked([hashes[k] for k in asked], np.uint64)
    d = unpacked([digests[k] for k in asked], np.uint64)
    i = unpacked([ids[k] for k in asked], np.int64)
    order, head, _, several, first = classes(h, d, i)
    h, d, i = h[order], d[order], i[order]
    for what, which in ((REPEATED, i > first), (ASKED, head & several)):
        rows += [(doc, what, keys) for doc, keys in per_document(i[which], key_of(h[which], d[which]))]
    found = pa.Table.from_batches([arrow(rows, ANSWER)])
    del rows, h, d, i, order, head, first
    give_back()
    return found


FOUND = "doc_id long, content long, spans array<int>, contexts array<struct<hash:long,at:int,before:binary,after:binary>>"


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the repeated spans (start, stop, ...), and the contexts that are asked for. The
    left side is reversed, so that both sides are read away from the anchor."""
    powers = powers_to(SLICE)
    for batch in batches:
        for part in slices(batch, SLICE):
            found = Anchors(part.column("text"), powers)
            keys = key_of(found.hash >> np.uint64(16), found.digest & np.uint64(0xFFFFFFFFFF))
            told, blob = part.column("told"), found.data.tobytes()
            said = told.flatten()
            words = [k or b"" for k in pc.struct_field(said, "keys").to_pylist()]
            kind = np.repeat(pc.struct_field(said, "kind").to_numpy(zero_copy_only=False), [len(k) // 8 for k in words])
            row = np.repeat(np.arange(part.num_rows), pc.fill_null(told.value_lengths(), 0).to_numpy(zero_copy_only=False))
            row = np.repeat(row, [len(k) // 8 for k in words])
            key = np.frombuffer(b"".join(words), np.uint64)
            whole = told_in(found.row, keys, row[kind == REPEATED], key[kind == REPEATED])
            here = np.flatnonzero(told_in(found.row, keys, row[kind == ASKED], key[kind == ASKED]) & ~whole)
            # In a text, contexts begin and end in the order of their anchors.
            lo, hi, of = found.lo[whole], found.hi[whole], found.row[whole]
            head = np.concatenate([[True], (lo[1:] > hi[:-1]) | (of[1:] != of[:-1])])[: len(lo)]
            last = np.append(head[1:], True)[: len(lo)]
            spans = np.stack([lo[head], hi[last]], axis=1) - found.offsets[of[head]][:, None]
            at, lo, hi = found.at[here], found.lo[here].tolist(), found.hi[here].tolist()
            struct = pa.StructArray.from_arrays(
                [
                    pa.array(found.hash[here].view(np.int64)),
                    pa.array((at - found.offsets[found.row[here]]).astype(np.int32)),
                    pa.array([blob[a:b][::-1] for a, b in zip(lo, at.tolist())], pa.binary()),
                    pa.array([blob[a:b] for a, b in zip((at + GRAM).tolist(), hi)], pa.binary()),
                ],
                ["hash", "at", "before", "after"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("content"),
                    pa.ListArray.from_arrays(2 * begins(of[head], part.num_rows), pa.array(spans.ravel().astype(np.int32))),
                    pa.ListArray.from_arrays(begins(found.row[here], part.num_rows), struct),
                ],
                ["doc_id", "content", "spans", "contexts"],
            )


def begins(row: np.ndarray, n: int) -> np.ndarray:
    """Where each of n rows begins among sorted row numbers, and their end."""
    return np.searchsorted(row, np.arange(n + 1)).astype(np.int32)


def told_in(row: np.ndarray, key: np.ndarray, told_row: np.ndarray, told_key: np.ndarray) -> np.ndarray:
    """Whether each (row, key) is among the told ones."""
    if not len(told_key):
        return np.zeros(len(key), bool)
    with np.errstate(over="ignore"):
        own, told = (k + mix(r.astype(np.uint64), 7) for r, k in ((row, key), (told_row, told_key)))
    order = np.argsort(told)
    told, told_row = told[order], told_row[order]
    at = np.minimum(np.searchsorted(told, own), len(told) - 1)
    return (told[at] == own) & (told_row[at] == row)


def merged(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The union of spans as (n, 2), touching ones joined."""
    if not len(lo):
        return np.zeros((0, 2), np.int32)
    order = np.argsort(lo, kind="stable")
    lo, top = lo[order], np.maximum.accumulate(hi[order])
    head = np.concatenate([[True], lo[1:] > top[:-1]])
    last = np.concatenate([head[1:], [True]])
    return np.stack([lo[head], top[last]], axis=1).astype(np.int32)


MASKS = "hash long, before binary, after binary, first long, mask long"
LEAST = "hash long, low int, before binary, after binary, least array<long>"
#: Strings of crowded anchors by how many bytes before the anchor they begin. Those of a piece share 44 bytes of 50 in a group.
PIECES = ((0, 6), (7, 13), (14, 20), (21, 26))


def shared_strings(group: list[tuple[bytes, bytes, int]]) -> tuple[list[tuple[int, int, list]], dict[tuple, int]]:
    """Contexts with strings that another one may have: number, first such string and names of
    these strings; and the smallest first document by name."""
    bounds = [(max(0, SIDE - len(after)), len(before)) for before, after, _ in group]
    holds = [0] * (SIDE + 1)  # contexts with a string that begins o bytes before
    for low, high in bounds:
        for o in range(low, high + 1):
            holds[o] += 1
    open_, texts = [], set()
    for k, ((low, high), (before, after, first)) in enumerate(zip(bounds, group)):
        # What no other context reaches is not shared: sides end where strings that can be do.
        while low <= high and holds[low] < 2:
            low += 1
        while low <= high and holds[high] < 2:
            high -= 1
        if low <= high:
            before, after = before[:high], after[: SIDE - low]
            texts.update((before, after))
            open_.append((k, before, after, first, low, high))
    if not open_:
        return [], {}
    every = sorted(texts)
    # A side that only begins another one is told apart from others just as that one is.
    longer: dict[bytes, bytes] = {}
    following = None
    for side in reversed(every):
        following = longer[side] = longer[following] if following is not None and following.startswith(side) else side
    sides = sorted(set(longer.values()))
    text: list[int] = []
    at = {}
    for k, side in enumerate(sides):
        at[len(text)] = side
        text += [b + len(sides) for b in side]
        text.append(k)  # a separator of its own
    name = {}  # of each side: the class of its first t bytes, for every t it has
    current, last = [0] * (SIDE + 1), b""
    for k, side in enumerate([at[i] for i in suffix_array(text) if i in at]):
        # Sides in order, each with what it shares with the side before it.
        fresh = common_prefix(last, side) + 1 if k else 0
        current = current[:fresh] + [k] * (SIDE + 1 - fresh)
        name[side] = current
        last = side
    smallest: dict[tuple[int, int, int], int] = {}
    found = []
    for k, before, after, first, low, high in open_:
        left, right = name[longer[before]], name[longer[after]]
        keys = [(o, left[o], right[SIDE - o]) for o in range(low, high + 1)]
        found.append((k, low, keys))
        for key in keys:
            if smallest.setdefault(key, first) > first:
                smallest[key] = first
    return found, smallest


def shared_masks(group: list[tuple[bytes, bytes, int]]) -> list[int]:
    """Bit o of each context's mask: the string that begins o bytes before the anchor is also in a
    context whose first document is smaller."""
    found, smallest = shared_strings(group)
    masks = [0] * len(group)
    for k, low, keys in found:
        first, mask = group[k][2], 0
        for o, key in enumerate(keys, low):
            if smallest[key] < first:
                mask |= 1 << o
        masks[k] = mask
    return masks


def least_firsts(group: list[tuple[bytes, bytes, int]], low: int) -> list[list[int]]:
    """The smallest first document of each string of a context, from ``low`` bytes before the anchor on."""
    begin = [max(low, SIDE - len(after)) for _, after, _ in group]
    least = [[first] * (len(before) - b + 1) for b, (before, _, first) in zip(begin, group)]
    found, smallest = shared_strings(group)
    for k, start, keys in found:
        least[k][start - begin[k] : start - begin[k] + len(keys)] = [smallest[key] for key in keys]
    return least


def by_group(batches: Iterator[pa.RecordBatch], keys: int, work: Callable[[list[tuple]], list[tuple]], schema: str) -> Iterator[pa.RecordBatch]:
    """``work`` on the rows of each group, which come sorted by the first ``keys`` columns."""
    group: list[tuple] = []
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and row[:keys] != group[0][:keys]:
                rows.extend(work(group))
                group = []
            group.append(row)
        if rows:
            yield arrow(rows, schema)
            rows = []
    if group:
        rows.extend(work(group))
    yield arrow(rows, schema)


def order_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of contexts (hash, before, after, first) that come sorted by anchor."""

    def work(group):
        masks = shared_masks([row[1:] for row in group]) if len(group) > 1 else [0]
        return [(*row, mask) for row, mask in zip(group, masks)]

    return by_group(batches, 1, work, MASKS)


def order_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First documents of the strings of pieces (hash, low, left, right, before, after, first) that come sorted."""

    def work(group):
        least = least_firsts([row[4:] for row in group], group[0][1])
        return [(h, low, before, after, x) for (h, low, _, _, before, after, _), x in zip(group, least)]

    return by_group(batches, 4, work, LEAST)


def start_of(low: str = "low", after: str = "after"):
    return F.greatest(F.col(low), SIDE - F.octet_length(after))


def masks_by_pieces(big: DataFrame) -> DataFrame:
    """The same masks for anchors of very many contexts. These are cut to a few neighbouring strings;
    equal pieces become one, and those that agree in what all their strings hold go to the suffix array."""
    spans = F.array(*[F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")) for low, high in PIECES])
    pieces = (
        big.select("hash", "first", F.col("before").alias("b"), F.col("after").alias("a"), F.explode(spans).alias("span"))
        .select("hash", "first", "b", "a", "span.*")
        .withColumns({"before": F.substring("b", 1, F.col("high")), "after": F.substring("a", 1, SIDE - F.col("low"))})
        .where(start_of() <= F.octet_length("before"))
    )
    cut = pieces.groupBy("hash", "low", "high", "before", "after").agg(F.min("first").alias("first"))
    cut = cut.withColumns({"left": F.substring("before", 1, F.col("low")), "right": F.substring("after", 1, SIDE - F.col("high"))})
    cut = materialize(cut, "pieces")
    key = ["hash", "low", "left", "right"]
    crowded = cut.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select(*key)
    small = cut.join(crowded, key, "left_anti").select(*key, "before", "after", "first")
    small = small.repartition(*key).sortWithinPartitions(*key).mapInArrow(lean(order_pieces), LEAST)
    least = small.unionByName(firsts_by_rows(cut.join(crowded, key, "left_semi")))
    bit = "aggregate(sequence(0, size(least) - 1), 0L, (m, i) -> m | if(least[i] < first, shiftleft(1L, start + i), 0L))"
    masks = pieces.join(least, ["hash", "low", "before", "after"]).withColumn("start", start_of()).withColumn("mask", F.expr(bit))
    masks = masks.groupBy("hash", "b", "a", "first").agg(F.bit_or("mask").alias("mask"))
    return masks.withColumnsRenamed({"b": "before", "a": "after"})


def firsts_by_rows(crowded: DataFrame) -> DataFrame:
    """The same first documents where very many pieces agree in what all their strings hold: a row per string."""
    o = F.explode(F.sequence(start_of(), F.octet_length("before"))).alias("o")
    strings = crowded.select("*", o).withColumns(
        {"b": F.substring("before", 1, F.col("o")), "a": F.substring("after", 1, SIDE - F.col("o"))}
    )
    key = ["hash", "o", "b", "a"]
    of = strings.join(strings.groupBy(*key).agg(F.min("first").alias("smallest")), key)
    all_ = F.array_sort(F.collect_list(F.struct("o", "smallest")))  # of a piece: seven at most
    of = of.groupBy("hash", "low", "before", "after").agg(all_.alias("all"))
    return of.select("hash", "low", "before", "after", F.col("all.smallest").alias("least"))


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    for batch in batches:
        rows, held = [], 0
        for doc_id, text, spans, more in zip(*(batch.column(c) for c in ("doc_id", "text", "spans", "more")), strict=True):
            data = text.as_buffer().to_pybytes()
            pairs = [np.asarray(spans.as_py() or [], np.int64).reshape(-1, 2)]
            for m in more.as_py() or []:
                if m["whole"]:
                    pairs.append(np.array([[m["at"] - m["n_before"], m["at"] + GRAM + m["n_after"]]]))
                else:
                    begin = m["at"] - np.array([o for o in range(SIDE + 1) if m["mask"] >> o & 1], np.int64)
                    pairs.append(np.stack([begin, begin + LENGTH], axis=1))
            pairs = np.concatenate(pairs)
            removed = merged(pairs[:, 0], pairs[:, 1]).tolist()
            kept = b"".join(data[a:b] for a, b in zip([0, *(r[1] for r in removed)], [*(r[0] for r in removed), len(data)]))
            rows.append((doc_id.as_py(), len(data), len(data) - len(kept), len(removed), hashlib.sha256(kept).hexdigest(), kept))
            held += len(kept)
            if held > PART_BYTES:
                yield arrow(rows, schema)
                rows, held = [], 0
        yield arrow(rows, schema)


def remove_repeats(docs: DataFrame, *, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the remaining bytes) of every row."""
    spark = docs.sparkSession
    texts = whole_texts(docs).withColumn("content", F.xxhash64("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = math.ceil((total + 1) / bucket_bytes)
    named = texts.where("doc_id is not null")
    asked = named.mapInArrow(lean(lambda it: requests(it, buckets)), REQUEST)
    told = asked.groupBy("bucket").applyInArrow(answers, ANSWER).groupBy("doc_id").agg(F.collect_list(F.struct("kind", "keys")).alias("told"))
    found = materialize(named.join(told, "doc_id").select("doc_id", "content", "text", "told").mapInArrow(lean(contexts), FOUND), "repeats")
    single = found.select("doc_id", "content", F.explode("contexts").alias("c")).select("doc_id", "content", "c.*")
    distinct = single.groupBy("hash", "before", "after").agg(F.min("doc_id").alias("first"))
    distinct = materialize(distinct, "contexts")
    crowded = distinct.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("hash")
    small = distinct.join(crowded, "hash", "left_anti").select("hash", "before", "after", "first")
    small = small.repartition("hash").sortWithinPartitions("hash").mapInArrow(lean(order_contexts), MASKS)
    big = masks_by_pieces(distinct.join(crowded, "hash", "left_semi"))
    masks = small.unionByName(big.select(*[f.split()[0] for f in MASKS.split(", ")]))
    mark = F.struct(
        "at", F.octet_length("before").alias("n_before"), F.octet_length("after").alias("n_after"), (F.col("doc_id") > F.col("first")).alias("whole"), "mask"
    )
    more = single.join(masks, ["hash", "before", "after"]).where("doc_id > first or mask <> 0").groupBy("doc_id", "content").agg(F.collect_set(mark).alias("more"))
    spans = found.select("doc_id", "content", "spans").where("size(spans) > 0").groupBy("doc_id", "content").agg(F.first("spans").alias("spans"))
    both = spans.join(more, ["doc_id", "content"], "full").withColumnsRenamed({"doc_id": "r_id", "content": "r_content"})
    joined = texts.join(both, (texts["doc_id"] == both["r_id"]) & (texts["content"] == both["r_content"]), "left")
    out = joined.select("doc_id", "text", "spans", "more").mapInArrow(lean(cut_out), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return out
