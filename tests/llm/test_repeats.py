import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from crawlflow.llm import repeats as R
from crawlflow.llm.common import table
from crawlflow.llm.suffix_array import common_prefixes, suffix_array


def brute(rows):
    """Rows of (doc_id, text): the contract, string by string."""
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            if d is not None:
                least[b[i : i + 50]] = min(d, least.get(b[i : i + 50], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if d is not None and least[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_bytes int")
    got = R.remove_repeats(docs, bucket_bytes=2000).drop("kept").collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("letters", [1, 2, 3, 30])
def test_suffix_array(letters):
    rng = random.Random(letters)
    for _ in range(300):
        text = [rng.randrange(letters) for _ in range(rng.randrange(50))]
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert suffix_array(text) == want
        for (i, j), h in zip(zip(want, want[1:]), common_prefixes(text, want)[1:]):
            a, b = text[i:], text[j:]
            assert h == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def planted(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé ", k=rng.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randrange(8, 30)) for _ in range(8)]
    rows = []
    for d in rng.sample(range(1000), 90):
        parts = [rng.choice(passages) if rng.random() < 0.5 else text(rng.randrange(20)) for _ in range(rng.randrange(5))]
        if rows and rng.random() < 0.3:
            base = rng.choice(rows)[1]
            k = rng.randrange(len(base) + 1)
            parts = [base[:k] + rng.choice(["", "x"]) + base[k:]]
        rows.append((d, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed, group", [(1, 2048), (2, 2048), (3, 3)])
def test_matches_brute_force(spark, monkeypatch, seed, group):
    monkeypatch.setattr(R, "GROUP", group)
    rows = planted(seed)
    got = found(spark, rows)
    assert got == brute(rows)
    assert sum(r[2] > 0 for r in got) > 20


def test_edges(spark):
    long = "".join(random.Random(9).choices("abcdefgh ", k=120_000))
    rows = [
        (1, None), (2, ""), (3, "a" * 49), (4, "a" * 49), (5, "b" * 50), (6, "b" * 50), (7, "b" * 75), (7, "b" * 75), (None, "b" * 60),
        (8, long), (9, long[500:] + "z"), (10, "z" + long[:60]), (10, "y" + long[70:140]), (11, "é" * 40), (12, "xé" + "é" * 39),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_query_on_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in R.remove_repeats(docs).drop("kept").collect()), key=repr)
    assert got == brute(rows)


def test_leftmost_least_goes_by_upper_bits():
    x = np.array([9 << 31, (3 << 31) + 5, (3 << 31) + 1, 8 << 31, 2 << 40, 7 << 31, 7 << 31], np.uint64)
    assert R.leftmost_least(x, 3).tolist() == [1, 1, 2, 5, 5]


def brute_masks(group):
    strings = [{o: b[:o] + b"|" + a[: R.SIDE - o] for o in range(max(0, R.SIDE - len(a)), len(b) + 1)} for b, a, _ in group]
    return [
        sum(1 << o for o, x in own.items() if any(other.get(o) == x and f < first for other, (_, _, f) in zip(strings, group, strict=True)))
        for own, (_, _, first) in zip(strings, group, strict=True)
    ]


@pytest.mark.parametrize("most", [2, 3, 9])
def test_masks_against_brute_force(most):
    rng = random.Random(most)
    shared = 0
    for _ in range(300):
        long = [[bytes(rng.choices(b"ab", k=R.SIDE)) for _ in range(2)] for _ in range(2)]
        group = {}
        while len(group) < most:
            high = rng.randrange(R.SIDE + 1)
            low = rng.randrange(high + 1)
            before, after = (bytearray(rng.choice(side)) for side in long)
            for side in (before, after):
                if rng.random() < 0.2:
                    side[rng.randrange(R.SIDE)] ^= 1
            group[bytes(before[:high]), bytes(after[: R.SIDE - low])] = rng.randrange(5)
        group = [(b, a, f) for (b, a), f in group.items()]
        assert R.shared_masks(group) == brute_masks(group)
        shared += any(brute_masks(group))
    assert shared > 20


def test_only_sides_that_can_be_shared_are_ordered(monkeypatch):
    ordered = []
    monkeypatch.setattr(R, "suffix_array", lambda text: ordered.append(len(text)) or suffix_array(text))
    x, y = bytes(range(65, 65 + R.SIDE)), bytes(range(97, 97 + R.SIDE))
    assert R.shared_masks([(x[:5], y, 1), (x[:20], y[:16], 2)]) == [0, 0]  # strings from 0 to 5 and from 10 to 20 before
    assert ordered == []
    assert R.shared_masks([(x[:5], y, 1), (x[:20], y[: R.SIDE - 5], 2)]) == [0, 1 << 5]
    assert ordered == [5 + 1 + R.SIDE - 5 + 1]  # one string in common: x[:5] and what follows it


def test_contexts_of_several_texts():
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefgh", k=n)) for n in (400, 10, 0, 300, 500)]
    all_ = R.Anchors(pa.array(texts), R.powers_to(R.SLICE))
    keys = R.key_of(all_.hash >> np.uint64(16), all_.digest & np.uint64(0xFFFFFFFFFF))
    of = lambda row, which: keys[all_.row == row][which].tobytes()
    told = [
        [{"kind": R.REPEATED, "keys": of(0, slice(0, 2))}, {"kind": R.ASKED, "keys": of(0, slice(1, 4))}, {"kind": R.REPEATED, "keys": of(3, slice(0, 1))}],
        [], None, [{"kind": R.ASKED, "keys": of(3, slice(0, 1))}], [{"kind": R.REPEATED, "keys": of(4, slice(None))}],
    ]
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("keys", pa.binary())]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5)), pa.array(range(5)), pa.array(texts), pa.array(told, kind)], ["doc_id", "content", "text", "told"]
    )
    out = next(R.contexts(iter([batch]))).to_pylist()
    own = np.flatnonzero(all_.row == 0)
    assert out[0]["spans"] == R.merged(all_.lo[own[:2]], all_.hi[own[:2]]).ravel().tolist()
    assert [(r["spans"], r["contexts"]) for r in out[1:3]] == [([], [])] * 2
    assert out[3]["spans"] == [] and out[4]["spans"] == [0, 500] and out[4]["contexts"] == []
    assert [len(out[k]["contexts"]) for k in (0, 3)] == [2, 1]  # what is repeated as a whole is not asked for
    for k, c in [(0, c) for c in out[0]["contexts"]] + [(3, out[3]["contexts"][0])]:
        at = c["at"]
        assert texts[k].encode()[at - len(c["before"]) : at] == c["before"][::-1]
        assert texts[k].encode()[at + R.GRAM : at + R.GRAM + len(c["after"])] == c["after"]


@pytest.mark.parametrize("group", [2, 100])
def test_masks_of_crowded_anchors(spark, monkeypatch, group):
    monkeypatch.setattr(R, "GROUP", group)
    rng = random.Random(group)
    contexts = {}
    x, y = b"b" * R.SIDE, b"a" * R.SIDE
    for _ in range(60):
        high = rng.randrange(R.SIDE + 1)
        before, after = bytearray(x[:high]), bytearray(y[: R.SIDE - rng.randrange(high + 1)])
        for side in (before, after):
            if side and rng.random() < 0.4:
                side[rng.randrange(len(side))] ^= rng.randrange(3)
        contexts[bytes(before), bytes(after)] = rng.randrange(9)
    rows = [(h, b, a, f) for h in (1, 2) for (b, a), f in contexts.items()]
    big = spark.createDataFrame([(h, bytearray(b), bytearray(a), f) for h, b, a, f in rows], "hash long, before binary, after binary, first long")
    got = {(r["hash"], bytes(r["before"]), bytes(r["after"])): r["mask"] for r in R.masks_by_pieces(big).collect()}
    want = brute_masks([r[1:] for r in rows[: len(rows) // 2]]) * 2
    assert got == {r[:3]: mask for r, mask in zip(rows, want, strict=True)}
    assert sum(map(bool, want)) > 40


def test_strings_are_exploded_only_where_pieces_crowd(spark, monkeypatch):
    rows_of = []
    by_rows = R.firsts_by_rows
    monkeypatch.setattr(R, "firsts_by_rows", lambda crowded: rows_of.append(crowded.count()) or by_rows(crowded))
    monkeypatch.setattr(R, "GROUP", 20)
    # One anchor, 60 contexts that differ in what stands 20 bytes and more before it.
    rows = [(1, bytearray(b"x" * 20 + bytes([k, k, k])), bytearray(b"y" * R.SIDE), k) for k in range(60)]
    got = R.masks_by_pieces(spark.createDataFrame(rows, "hash long, before binary, after binary, first long")).collect()
    assert {r["first"]: r["mask"] for r in got} == {k: (1 << 21) - 1 if k else 0 for k in range(60)}
    assert rows_of == [0]  # before: each of the 60 contexts, with 24 strings
