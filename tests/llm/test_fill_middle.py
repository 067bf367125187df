import random
from hashlib import sha256

import numpy as np
import pytest

from crawlflow.llm import fill_middle as M

ALPHABET = list("abc \n.<>PSM") + ["é", "日", "😀", "<P", "S>"]


def brute(doc_id, text):
    text = text or ""
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    p, m = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return doc_id, len(text), "plain", None, None, text
    a, b, c = text[:p], text[p:m], text[m:]
    if h[3] % 100 < 20:
        return doc_id, len(text), "spm", p, m - p, f"<S>{c}<P>{a}<M>{b}"
    return doc_id, len(text), "psm", p, m - p, f"<P>{a}<S>{c}<M>{b}"


def texts(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(most))) for _ in range(n)]


def test_like_brute_force(spark):
    rows = [(i, t, i, "x") for i, t in enumerate(["", "a", "é", "<P>", "a<S>b", "<M", "😀" * 9, *texts(1, 200, 60), *texts(2, 20, 3000)])]
    rows += [(None, "no id at all", 0, None), (7, None, 0, None), (3, "<P>", 3, "x"), (3, "<P>", 3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, form string")
    got = M.fill_middle(docs).withColumn("back", M.restore()).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((brute(i, t) for i, t, *_ in rows), key=repr)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t, *_ in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_long_texts(spark):
    long = ["a" * 3_000_000, "é日a" * 700_000, "x" + "😀" * 400_000 + "y" * 900_000, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(long * 2)], "doc_id long, text string")
    got = M.fill_middle(docs).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(i, t) for i, t in enumerate(long * 2))


def test_empty_table(spark):
    assert M.fill_middle(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []


@pytest.mark.parametrize("stretch", [1 << 20, 64, 7])
def test_index_is_exact_and_bounded(stretch):
    for seed in range(20):
        parts = [t.encode() for t in texts(seed, 12, 400)] + [b"", b"a" * 500 + "😀".encode() * 500]
        begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        data = np.frombuffer(b"".join(parts), np.uint8)
        index, first = M.index_texts(data, begins, stretch=stretch)
        want = np.concatenate([np.flatnonzero((data & 0xC0) != 0x80), [len(data)]])
        ranks = np.arange(len(want))
        assert (index(ranks) == want).all()
        assert np.abs(index.predict(ranks) - want).max() <= M.BOUND
        assert first.tolist() == np.searchsorted(want, begins).tolist()


def test_even_texts_take_one_segment():
    index = M.fit(np.arange(0, 100_000, 2), np.zeros(1, np.int64))
    assert len(index.first) == 1 and not index.residuals.any()
