import random
import re

import numpy as np
import pyarrow as pa

from crawlflow.llm import decontamination as D
from crawlflow.llm.common import table
from crawlflow.llm.words import words_of


def tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        last, row = row, [i]
        for j, x in enumerate(text, 1):
            row.append(min(last[j - 1] + (w != x), last[j] + 1, row[-1] + 1))
    return min(row)


def test_words():
    texts = ["", "A b1 c", None, "c", "É-x y_z", "日本 a"]
    got = words_of(pa.array(texts))
    want = [(i, w) for i, t in enumerate(texts) for w in tokens(t)]
    assert got.rows.tolist() == [i for i, _ in want]
    by_word = {}
    for h, (_, w) in zip(got.hashes.tolist(), want, strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_distance():
    rng = random.Random(1)
    for _ in range(200):
        item, text = rng.choices("abc", k=rng.randrange(1, 80)), rng.choices("abc", k=rng.randrange(90))
        assert D.distance(list(map(ord, item)), list(map(ord, text)))[0] == brute_distance(item, text)


def planted(seed, n_docs=150, n_items=25):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and"] * 10 + [f"w{k}" for k in range(600)]
    items = [rng.choices(vocabulary, k=rng.randrange(12, 60)) for _ in range(n_items)]
    docs = []
    for i in range(n_docs):
        words = rng.choices(vocabulary, k=rng.randrange(200))
        if i % 3 == 0:
            leak = list(rng.choice(items))
            for _ in range(rng.randrange(D.edits(len(leak)) + 3)):
                k = rng.randrange(len(leak))
                leak[k : k + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(2))
            words[5:5] = leak
        docs.append(words)
    return items, docs


def test_leaks_match_brute_force(spark):
    items, docs = planted(4)
    frame = spark.createDataFrame([(i, " ".join(d), "x") for i, d in enumerate(docs)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in D.leaks(frame, bench).collect()}
    want = {}
    for d, words in enumerate(docs):
        for i, item in enumerate(items):
            if (e := brute_distance(item, words)) <= D.edits(len(item)):
                want[d, i] = e
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want) and len(want) > 30
    assert all(got[k] == want[k] for k in got)
    assert {r.doc_id for r in D.clean(frame, bench).collect()} == set(range(len(docs))) - {d for d, _ in got}


def edited(rng, item, kind, k):
    """``item`` with ``k`` edits at places of their own; nothing else has the words put in."""
    words = [[w] for w in item]
    for j, at in enumerate(rng.sample(range(len(item)), k)):
        words[at] = [] if kind == "deletion" else [f"new{j}"] + (words[at] if kind == "insertion" else [])
    return [w for part in words for w in part]


def test_recall_at_the_limit_by_size_and_kind(spark):
    rng = random.Random(9)
    items, docs, want = [], [], set()
    for n in (5, 9, 10, 16, 39, 59, 120, 250):
        for kind in ("substitution", "deletion", "insertion"):
            for _ in range(4):
                item = rng.sample([f"w{k}" for k in range(900)], n)
                docs.append(["a"] * rng.randrange(30) + edited(rng, item, kind, D.edits(n)) + ["b"] * rng.randrange(30))
                want.add((len(docs) - 1, len(items)))
                items.append(item)
    frame = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in D.leaks(frame, bench).collect()}
    assert want <= set(got)
    assert all(got[d, i] == brute_distance(items[i], docs[d]) for d, i in got)


def test_edges(spark):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one two"), (5, item)], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item.upper() + "!"), (3, item.upper() + "!"), (4, "x " * 60_000 + item), (5, "one two"), (6, item[:-8]), (None, item), (7, item[8:])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    got = sorted((r.doc_id, r.item_id, r.edits) for r in D.leaks(docs, bench).collect())
    assert got == sorted((d, i, e) for d, e in ((3, 0), (4, 0), (6, 2), (7, 2)) for i in (1, 5))
    assert D.leaks(docs.where("false"), bench).collect() == [] == D.leaks(docs, bench.where("false")).collect()
    assert D.clean(docs, bench).count() == 4 and D.clean(docs, bench).columns == docs.columns


def test_expected_recall():
    assert D.expected_recall(0.0) == 1 and D.expected_recall(0.3) > 0.99


def test_every_verbatim_item_is_found(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: tokens(r.text) for r in table(spark, sf, "documents").collect()}
    items = {r.item_id: tokens(r.text) for r in table(spark, sf, "benchmark").collect()}
    got = {(r.doc_id, r.item_id) for r in D.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark")).collect()}
    joined = {d: " " + " ".join(w) + " " for d, w in docs.items()}
    want = {(d, i) for d, t in joined.items() for i, w in items.items() if " " + " ".join(w) + " " in t}
    assert want and want <= got
    assert all(brute_distance(items[i], docs[d]) <= D.edits(len(items[i])) for d, i in list(got)[:40])
    assert np.mean([d in {x for x, _ in got} for d in docs]) < 0.2
