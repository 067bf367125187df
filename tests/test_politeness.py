import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crawlflow.operators import politeness as P
from crawlflow.operators.sequence import with_position


def visits(spark, rows):
    frame = spark.createDataFrame(rows, "id int, domain string, ms long")
    return frame.select("id", "domain", F.timestamp_millis("ms").alias("ts"))


def schedule(rows, delay):
    release, gap, last = {}, {}, {}
    seen = {}
    for i, domain, ms in sorted(rows, key=lambda r: (r[2], r[0])):
        release[i] = max(ms, last[domain] + delay) if domain in last else ms
        last[domain] = release[i]
        gap[i] = max(0, delay - (ms - seen[domain])) if domain in seen else 0
        seen[domain] = ms
    return release, gap


def test_golden_schedule(spark):
    rows = [(i, "d", ms) for i, ms in enumerate([0, 100, 2500, 2600])]
    got = P.throttle_plan(visits(spark, rows), "domain", "ts", "id").orderBy("id").collect()
    assert [r.release_ms for r in got] == [0, 1000, 2500, 3500]


def test_chunks_change_nothing(spark):
    """A hot domain with two thirds of the rows, cut into many chunks."""
    rng = random.Random(1)
    rows = [
        (i, "hot" if rng.random() < 0.66 else f"d{rng.randint(0, 5)}", rng.randint(0, 40_000))
        for i in range(600)
    ]
    release, gap = schedule(rows, 70)
    for chunk_ms in (50, 1000, 10**9):
        plan = P.throttle_plan(visits(spark, rows), "domain", "ts", "id", 70, chunk_ms).collect()
        assert {r.id: r.release_ms for r in plan} == release
        waits = P.throttle_gap(visits(spark, rows), "domain", "ts", "id", 70, chunk_ms).collect()
        assert {r.id: r.wait_ms for r in waits} == gap


def offered(spark, domains):
    return spark.createDataFrame(
        [(i, f"u{i}", d) for i, d in enumerate(domains, 1)], "idx long, url string, domain string"
    )


def test_recent_share(spark):
    rng = random.Random(2)
    domains = [rng.choice("aaab") if rng.random() < 0.8 else "c" for _ in range(500)]
    want = {}
    for i, d in enumerate(domains):
        before = domains[max(0, i - 100) : i]
        want[i + 1] = 100.0 * before.count(d) / len(before) if before else 0.0
    for block in (7, 64, 65_536):
        got = P.recent_domain_share(offered(spark, domains), block=block).collect()
        assert {r.idx: r.share for r in got} == want
        assert all(r.overloaded == (r.share > 15) for r in got)


def test_recent_urls(spark):
    got = [r.url for r in P.recent_urls(offered(spark, "abcdef"), 3).collect()]
    assert got == ["u6", "u5", "u4"]


def check_spread(rows, n, workers, before=None):
    """No worker twice in a row at a domain, turns without gaps, as few deferred as possible."""
    assert sorted(r.idx for r in rows) == list(range(1, n + 1))
    by_worker = {w: sorted((r.turn, r.domain) for r in rows if r.worker == w) for w in range(workers)}
    for w, visits_ in by_worker.items():
        assert [t for t, _ in visits_] == list(range(len(visits_)))
        domains = ([before[w]] if before and w in before else []) + [d for _, d in visits_]
        assert all(a != b for a, b in zip(domains, domains[1:])), (w, domains)
    deferred = [r for r in rows if r.reason == "no_worker"]
    assert all(r.worker is None and r.turn is None for r in deferred)
    assert all((r.worker is None) == (r.reason is not None) for r in rows)
    return by_worker, deferred


@pytest.mark.parametrize("workers, sizes", [
    (1, [40] * 5), (4, [40] * 5), (2, [3, 3, 2]), (5, [100, 10, 10, 5]), (1, [100, 10, 10, 5]), (4, [200]), (1, [50, 49]), (2, [50, 49]),
    (5, [1] * 30), (4, [60, 20, 20, 19]), (2, [7, 7]), (1, [1]),
])
def test_spread(spark, workers, sizes):
    domains = [chr(97 + k) for k, n in enumerate(sizes) for _ in range(n)]
    random.Random(workers).shuffle(domains)
    rows = P.spread_workers(offered(spark, domains), workers).collect()
    by_worker, deferred = check_spread(rows, len(domains), workers)
    # Only a domain that fills more than half of a worker's turns has to wait, and only what is too much.
    top = max(sizes)
    assert len({r.domain for r in deferred}) <= 1
    if 2 * top <= sum(sizes) - workers:
        assert not deferred
    for w, visits_ in by_worker.items():
        n_others = sum(d != "a" for _, d in visits_)
        assert len(visits_) <= 2 * n_others + 1 if deferred else True
    load = [len(v) for v in by_worker.values()]
    if not deferred:
        assert max(load) - min(load) <= 1


def test_rounds_follow_each_other(spark):
    """The last visits of a round are handed to the next one, with what it deferred."""
    rng = random.Random(9)
    last, before, late = None, None, []
    for _ in range(4):
        domains = rng.choices("aaaabbc", k=rng.randrange(5, 40)) + late
        spread = P.spread_workers(offered(spark, domains), 3, last=last)
        rows = spread.collect()
        by_worker, deferred = check_spread(rows, len(domains), 3, before)
        before = (before or {}) | {w: v[-1][1] for w, v in by_worker.items() if v}
        last = spark.createDataFrame(list(before.items()), "worker int, domain string")
        found = {r.worker: r.domain for r in P.last_visits(spread).collect()}
        assert found == {w: v[-1][1] for w, v in by_worker.items() if v}
        late = [r.domain for r in deferred]
    alone = P.spread_workers(offered(spark, ["a"]), 1, last=spark.createDataFrame([(0, "a")], "worker int, domain string")).collect()
    assert [r.reason for r in alone] == ["no_worker"]


def test_overloaded_domains_are_deferred(spark):
    domains = ["hot"] * 60 + [f"d{k % 23}" for k in range(140)] + [None] * 3
    random.Random(3).shuffle(domains)
    frame = offered(spark, domains)
    rows = P.spread_workers(frame, 4, defer_overloaded=True).collect()
    check_spread(rows, len(domains), 4)
    named = frame.fillna("", ["domain"])
    over = {r.idx for r in P.recent_domain_share(named).where("overloaded").collect()}
    assert {r.idx for r in rows if r.reason == "overloaded"} == over and over


def test_nothing_to_spread(spark):
    assert P.spread_workers(offered(spark, ["a"]).where("false")).count() == 0


def test_rows_without_domain_stay(spark):
    rows = [(1, None, 5), (2, "a", 5), (3, None, 6), (4, "a", None)]
    frame = visits(spark, rows)
    plan = P.throttle_plan(frame, "domain", "ts", "id").collect()
    assert {r.id: r.release_ms for r in plan} == {1: 5, 2: 5, 3: 6, 4: None}
    waits = P.throttle_gap(frame, "domain", "ts", "id").collect()
    assert {r.id: r.wait_ms for r in waits} == {1: 0, 2: 0, 3: 0, 4: 0}


def test_position(spark):
    ids = random.Random(4).sample(range(-5_000, 2**60), 900)
    frame = spark.createDataFrame([(i, str(i)) for i in ids], "id long, name string").repartition(5)
    placed = with_position(frame, "name").collect()
    assert {r.name: r.pos for r in placed} == {n: i for i, n in enumerate(sorted(map(str, ids)))}
    placed = with_position(frame, "id", name="idx", first=1).collect()
    assert {r.id: r.idx for r in placed} == {n: i for i, n in enumerate(sorted(ids), 1)}
