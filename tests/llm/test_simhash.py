import random
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from crawlflow.llm import queries, simhash as S


def brute_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").translate({9 + k: " " for k in range(5)}).split(" ")
    words = [w for w in words if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Of (doc_id, fp) pairs: doc_id -> smallest doc_id reachable."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
            a, b = sorted((root(i), root(j)), key=lambda k: prints[k][0])
            parent[b] = a
    return [prints[root(i)][0] for i in range(len(prints))]


def test_every_pair_within_the_radius_meets_in_a_table():
    for i, j in combinations(range(64), 2):
        assert any(not S.kept(t)[i] and not S.kept(t)[j] for t in S.TABLES)


def test_fingerprint():
    for text in ["", " ", "a", "A b", "a b c", "A\tB\x0bc\nd É é a b c", "x " * 500, "日本 語 x y"]:
        assert S.fingerprint(text) == brute_fingerprint(text)


def test_links_match_brute_force(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for fp in base:
        for _ in range(12):
            for _ in range(rng.randrange(4)):
                fp ^= 1 << rng.randrange(64)
            prints.add(fp)
    prints = sorted((S.signed(p) for p in prints))
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {r.node: r.component for r in S.components(S.links(frame)).collect()}
    want = brute_components([(p, p & (1 << 64) - 1) for p in prints])
    assert [found.get(p, p) for p in prints] == want


def test_near_duplicates_edges(spark):
    rows = [(5, None, 1), (3, "", 1), (9, " \t", 2), (7, "a b c d", 0), (7, "a b c d", 0), (None, "a b c d", 3), (8, "q w e r t", 1), (None, "only one here", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.component_id) for r in S.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (7, 7), (7, 7), (None, 7), (8, 8), (None, None)], key=repr)
    assert sorted(r.doc_id or 0 for r in S.one_of_each(docs).collect()) == [0, 0, 3, 7, 7, 8]
    assert S.near_duplicates(docs.where("false")).collect() == []


def test_query_matches_brute_force(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    source.write.parquet(f"{tmp_path}/documents.parquet")
    rows = source.select("doc_id", "text").orderBy("doc_id").collect()
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    want = [(d, f"{fp:016x}", c) for (d, fp), c in zip(prints, brute_components(prints), strict=True)]
    got = queries.QUERIES["op10_simhash"](spark, str(tmp_path)).orderBy(F.col("doc_id")).collect()
    assert [tuple(r) for r in got] == want
