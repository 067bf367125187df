import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest

from crawlflow.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    totals = {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(totals[k][0] for k in kids[p]) or 1
        gain = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        totals[p] = leaves, gain + sum(totals[k][1] for k in kids[p])
    return sorted((
        (members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), len(kids[p]), *totals[p],
         sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p in members
    ))


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = T.prefix_trie(T.rebuilt_paths(frame)).collect()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got) == brute(rows)


def made(seed, n, words, most):
    """Conversations of few distinct turns; a third are copies of one."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.33:
            rows += [(c, k, "user", f"copy {k} é") for k in range(4)]
            continue
        rows += [(c, k, rng.choice(["user", "bot"]), rng.choice(words)) for k in range(rng.randrange(1, most))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_like_brute_force(spark, shards, monkeypatch):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        check(spark, made(shards, 300, ["a", "b", "日本", ""], 6))
        check(spark, made(shards, 150, [f"w{k}" for k in range(500)], 12))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_blocks_and_names(spark):
    """Small bounds: children go by name and ids in blocks."""
    rows = made(5, 400, ["a", "b", "c"], 7)
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    paths = sorted((r.path, r.conv_id) for r in T.rebuilt_paths(frame).collect())
    bounds = T.KIDS, T.IDS
    T.KIDS, T.IDS = 2, 3
    try:
        work = T.Shard(0, {0: (-1, None, 0)}, None)
        for path, c in paths:
            work.add(c, bytes(path))
        out = [r for b in work.finish() for r in b.to_pylist()]
    finally:
        T.KIDS, T.IDS = bounds
    nodes = [r for r in out if r["kind"] == "node"]
    names = {(r["shard"], r["start"], r["depth"]): r["conv_id"] for r in nodes if r["shard"] is not None}
    ids = defaultdict(list)
    for r in sorted((r for r in out if r["kind"] == "ids"), key=lambda r: r["seq"]):
        ids[r["shard"], r["start"], r["depth"]].append(r["ends"])
    got = []
    for r in nodes:
        parent = r["parent_conv_id"] if r["p_shard"] is None else names[r["p_shard"], r["p_start"], r["depth"] - 1]
        ends = r["ends"] or sha256(",".join(ids[r["shard"], r["start"], r["depth"]]).encode()).hexdigest()
        got.append((r["conv_id"], r["depth"], -1 if parent is None else parent, *(r[c] for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), ends))
    assert any(r["p_shard"] is not None for r in nodes) and ids
    assert sorted(got) == brute(rows)


def test_edges(spark):
    rows = [
        (0, None, "user", "first"), (0, 1, None, None), (0, 1, None, None), (0, 2, "a", "b"), (1, 5, "user", "x"),
        (2, 0, "user", "x"), (None, 1, "user", "lost"), (-3, 0, "user", "x"), (-5, 0, "", ""), (7, 0, "u", "y" * 9000), (10, 3, "us", "erx"),
        (11, 3, "user", "x"),
    ]
    check(spark, rows)
    assert T.prefix_trie(T.rebuilt_paths(spark.createDataFrame([], SCHEMA))).collect() == []
    check(spark, [(15, k, "user", f"turn {k % 7}") for k in range(3000)] + [(16, k, "user", f"turn {k % 7}") for k in range(2500)])


def test_shared_turns():
    a, b = b"x" * 24, b"y" * 24
    assert T.shared_turns(a * 5 + b, a * 7) == 5
    assert T.shared_turns(b"", a) == 0
    assert T.shared_turns(a * 3, a * 3) == 3
