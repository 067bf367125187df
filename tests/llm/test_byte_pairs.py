import random

import pytest
import tiktoken

from crawlflow.llm import byte_pairs as B

ALPHABET = list("abcdefghinorstABC   ..\n\t éñß日本√0123456789'\x1c\x85") + ["the ", "ing", "'s", "'LL", "  ", "😀", "́"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    ranks = B.vocabulary(B.ranks_path()).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(seed, n, most, alphabet=ALPHABET):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randrange(most))) for _ in range(n)]


def ids_of(found, encoder=None):
    ids, ends = (encoder or B.Encoder(B.vocabulary(B.ranks_path()))).texts(found)
    return [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def test_like_the_library(spark, library):
    rows = [(i, t, 1, None) for i, t in enumerate(["", " ", "a", "<|endoftext|>", "a\u0000b", *texts(1, 300, 400)])]
    rows += [(900, None, 1, b"x"), (None, "x y", 1, None), (2, "a", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, bytes binary")
    encoded = B.encode(docs)
    got = sorted(((r.doc_id, r.n_tokens, r.ids) for r in encoded.collect()), key=repr)
    want = [(i, library.encode_ordinary(t or "")) for i, t, *_ in rows]
    assert got == sorted(((i, len(ids), ids) for i, ids in want), key=repr)
    back = B.decode(encoded.withColumn("bytes", encoded["n_tokens"])).collect()
    assert sorted((bytes(r.bytes).decode() for r in back)) == sorted(t or "" for _, t, *_ in rows)
    assert back[0].asDict().keys() == {"doc_id", "n_tokens", "bytes"}


@pytest.mark.parametrize("found", [
    texts(2, 30, 4000, "abcdefghij"), texts(3, 30, 3000, "aab"), texts(4, 20, 900, "日本語a国語" * 2 + "é"),
    ["a" * 5000, " " * 3000, "日本語" * 900, "ab" * 3000, "the" * 1000, "\n" * 700 + "x", "x" * 256, "x" * 257],
])
def test_long_matches(library, found):
    assert ids_of(found) == [library.encode_ordinary(t) for t in found]


def test_any_character(library):
    """Code points between others of each class split as in the library."""
    rng = random.Random(7)
    points = [c for c in (*range(0x3100), *rng.sample(range(0x3100, 0x110000), 6000)) if not 0xD800 <= c < 0xE000]
    encoder = B.Encoder(B.vocabulary(B.ranks_path()))
    for frame in ("a%sa", "1%s1", " %s b", "!%s!"):
        found = [frame % chr(c) for c in points]
        assert ids_of(found, encoder) == library.encode_ordinary_batch(found, num_threads=2)


def test_newer_letters(library):
    """A probe with tokens across a character's last byte and a letter shows its class."""
    import public_tokenizers

    ranks = {bytes([b]): b for b in range(256)} | {bytes([0x80 + k]) + b"a": 256 + k for k in range(64)}
    probe = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for c in (*range(0x80, 0x3100, 3), *(int(x, 16) for r in B.NEWER for x in r.split("-"))):
        if not 0xD800 <= c < 0xE000:
            text = chr(c) + "a"
            assert (len(probe.encode_ordinary(text)) < len(text.encode())) == (len(B.splitter(text).findall(text)) == 1), hex(c)


def test_memo_and_stream(library, monkeypatch):
    monkeypatch.setattr(B, "STREAM", 50)
    monkeypatch.setattr(B, "STREAM_CHARS", 1000)
    encoder = B.Encoder(B.vocabulary(B.ranks_path()), memo=20)
    for text in texts(5, 40, 4000):
        assert ids_of([text], encoder) == [library.encode_ordinary(text)]


def test_pairs_table():
    rng = random.Random(3)
    pairs = {(rng.randrange(500), rng.randrange(500)): k for k in range(5000)}
    import numpy as np

    left, right = np.array(list(pairs)).T
    lookup = B.PairRanks(left, right, np.array(list(pairs.values())))
    assert lookup(left.astype(np.int32), right.astype(np.int32)).tolist() == list(pairs.values())
    asked = np.array([(rng.randrange(-1, 600), rng.randrange(-1, 600)) for _ in range(5000)], np.int32)
    assert lookup(*asked.T).tolist() == [pairs.get(tuple(p), B.NONE) for p in asked.tolist()]


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert B.decode(B.encode(empty)).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.bytes) for r in B.decode(nothing).collect()] == [b"", b""]
    with pytest.raises(Exception, match="not in the rank file"):
        B.decode(spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>")).collect()
