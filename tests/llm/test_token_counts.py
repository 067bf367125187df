import random

import pytest
import sentencepiece

from crawlflow.llm import token_counts as T

SP = sentencepiece.SentencePieceProcessor(model_file=T.model_path())
ALPHABET = list("abcdefghinorst   ..\n\t éñß日本√▁<>s/0123") + ["the ", "ing", "  "]


def texts(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(most))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, lang string")


def test_counts_match_the_library(spark):
    rows = [(i, t, 7, None) for i, t in enumerate(["", " ", "a", " a  b ", "▁", "<s> </s>", *texts(1, 60, 400)])]
    rows += [(100, None, None, "en"), (1, " ", 7, None), (None, "x y", 0, None)]
    got = T.token_counts(frame(spark, rows)).collect()
    want = sorted(((i, len((t or "").encode()), len(SP.encode(t or ""))) for i, t, *_ in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_chunks_are_spliced(spark):
    long = [*texts(2, 6, 9000), "a" * 3000, "the ring " * 700, "日本" * 900, "ab" * 1000 + " " + "é" * 999]
    got = T.token_counts(frame(spark, [(i, t, 0, "") for i, t in enumerate(long)]), chunk_chars=300, overlap_chars=4)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {i: len(SP.encode(t)) for i, t in enumerate(long)}
    assert len(T.splices("the ring " * 700, T.model_path(), 300, 4)) > 15


def test_empty_table(spark):
    assert T.token_counts(frame(spark, [])).collect() == []


@pytest.mark.parametrize("at, expected", [(3, True), (2, False)])
def test_stable(at, expected):
    pieces, longest = T.vocabulary(T.model_path())
    assert T.stable("the▁ring", at, pieces, longest) is expected
