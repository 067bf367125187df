import hashlib
import random
from functools import reduce

import numpy as np
import pytest

from crawlflow.llm import queries, sentence_pieces as S
from crawlflow.llm.common import table

MODEL = S.lattice(S.model_path())
ALPHABET = list("abcdefghinorst   ..\n\t éñß日本√<>s/0123") + ["the ", "ing", "  ", "tion"]


def brute(text):
    """One Viterbi pass over all characters."""
    shown = S.prepared(text)
    best, before, _ = MODEL.forward(shown, {0: 0.0}, len(shown))
    return (best[-1], MODEL.trace(shown, before, len(shown))) if text else (0.0, [])


def some(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(most))) for _ in range(n)]


@pytest.mark.parametrize("text", ["", " ", "a", "  a  b ", "the thing", "日√", *some(1, 20, 200)])
def test_encode_and_decode(text):
    assert MODEL.encode(text) == brute(text)
    assert S.decoded(MODEL, MODEL.encode(text)[1]) == text


def test_product_is_associative():
    rng = np.random.default_rng(1)
    a, b, c = (np.where(rng.random((5, 5)) < 0.3, S.NEVER, -rng.integers(0, 50, (5, 5)).astype(float)) for _ in range(3))
    assert (S.combine(S.combine(a, b), c) == S.combine(a, S.combine(b, c))).all()
    assert reduce(S.combine, [a, b, c]).shape == (5, 5)


def test_giants(spark):
    texts = [*some(2, 5, 1500), "tion" * 150, "a" * 400 + " " + "ing" * 200, "日本" * 200, "the ring " * 99, "", None, "short one"]
    rows = [(i, t, 3) for i, t in enumerate(texts)] + [(None, "the ring " * 99, 1), (1, texts[1], 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = S.encode(docs, chunk_chars=40).collect()
    want = [(i, *brute(t or "")) for i, t, _ in rows]
    assert sorted([(r.doc_id, r.score, r.ids) for r in got], key=repr) == sorted(want, key=repr)
    assert S.encode(docs.where("false")).collect() == []


def test_query_round_trip(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r for r in queries.QUERIES["op3_sentence_pieces"](spark, "/root/testdata/sf0.001").collect()}
    for r in docs.collect():
        score, ids = MODEL.encode(r.text)
        assert got[r.doc_id].text_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
        assert (got[r.doc_id].n_pieces, got[r.doc_id].score) == (len(ids), score)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
