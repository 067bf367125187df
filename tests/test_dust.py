import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from crawlflow.operators import dust
from crawlflow.operators.dust_apply import MAX_STEPS, apply_decreasing, apply_rules, decreasing, one_direction
from crawlflow.sources.seeds import page_sizes
from crawlflow.sources.sinks import write_rules

SIX = [
    ("http://www.cnn.com/index.html", 1000),
    ("http://www.cnn.com/", 1100),
    ("http://www.nytimes.com/", 2000),
    ("http://www.nytimes.com/index.html", 2100),
    ("http://www.bbc.com/", 900),
    ("http://www.bbc.co.uk/", 950),
]


def size_log(spark, rows):
    return spark.createDataFrame(rows, "url string, size int")


# Input, exploded rows, buckets, likely rules, sum of support, final rules in order.
GOLDEN = [
    ([("ab/x", 10)], 6, 6, 0, 0, []),
    ([("ab/x", 10), ("ab/x", 10), ("cb/x", 10)], 18, 9, 6, 12, [("c", "a"), ("a", "c")]),
    ([("ab/x", 10), ("cb/x", 25)], 12, 9, 3, 3, [("c", "a")]),
    (
        [("http://www.cnn.com/", 1100), ("http://www.bbc.com/", 900)],
        156, 144, 24, 24, [("c", "b"), ("b", "c")],
    ),
    (SIX, 468, 210, 60, 216, [("c", "b"), ("n", "b"), ("b", "c"), ("n", "c"), ("c", "n")]),
]


@pytest.mark.parametrize("rows,exploded,buckets,likely,support,final", GOLDEN)
def test_head_golden(spark, rows, exploded, buckets, likely, support, final):
    log = size_log(spark, rows)
    rows_out = dust.envelopes(log, "head")
    assert rows_out.count() == exploded
    assert rows_out.select("prefix", "suffix").distinct().count() == buckets
    rules = dust.likely_rules(log, "head")
    assert rules.count() == likely
    assert (rules.agg(F.sum("support")).first()[0] or 0) == support
    assert [tuple(r) for r in dust.mine_rules(log, "head").collect()] == final


def test_full_golden(spark):
    log = size_log(spark, SIX)
    rows = dust.envelopes(log, "full")
    assert rows.count() == 1332
    assert rows.select("prefix", "suffix").distinct().count() == 1222
    rules = dust.likely_rules(log, "full")
    assert (rules.count(), rules.agg(F.sum("support")).first()[0]) == (212, 237)
    assert dust.mine_rules(log, "full").count() == 32
    assert rules.where("alpha = '/index.html' and beta = '/'").count() == 1


def test_pages_golden(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rules = dust.likely_rules(page_sizes(pages), "head")
    total = rules.agg(F.count("*"), F.sum("support"), F.max("support")).first()
    assert tuple(total) == (2990, 5_779_580, 81_361)
    assert dust.eliminate_redundant(dust.ranked_rules(rules)).count() == 714


def brute_rules(rows, scope, percent):
    """Rules by looking at all pairs of all buckets."""
    found, buckets = {}, {}
    for url, size in rows:
        line = url[: min(len(url) - 1, 12)] if scope == "head" else url
        for start in range(len(line)):
            for end in range(start + 1, min(len(line), start + 12) + 1):
                key = (line[:start], line[end:])
                buckets.setdefault(key, []).append((line[start:end], size))
    for members in buckets.values():
        if len(members) > 1000:
            continue
        for a, s1 in members:
            for b, s2 in members:
                near = abs(s1 - s2) // s1 < 0.2 if percent is None else 100 * abs(s1 - s2) < percent * s1
                if a != b and near:
                    found[a, b] = found.get((a, b), 0) + 1
    return found


@pytest.mark.parametrize("scope,percent", [("head", None), ("head", 20), ("full", None), ("full", 35)])
def test_likely_rules_against_all_pairs(spark, scope, percent):
    rng = random.Random(7)
    rows = [
        ("".join(rng.choice("ab/") for _ in range(rng.randint(1, 9))), rng.randint(1, 60))
        for _ in range(120)
    ]
    got = dust.likely_rules(size_log(spark, rows), scope, percent).collect()
    assert {(r.alpha, r.beta): r.support for r in got} == brute_rules(rows, scope, percent)


def test_pairs_without_a_rule_are_not_shuffled(spark):
    """Pages of one envelope whose sizes are far apart are dropped before the sums, near ones are kept."""
    rows = [(f"{c}z", 10 ** (k + 1)) for k, c in enumerate("abcdef")] + [("gz", 11)]
    rules = dust.likely_rules(size_log(spark, rows), size_percent=20)
    assert {(r.alpha, r.beta, r.support) for r in rules.collect()} == {
        (a, b, 1) for x, y in ("ag", "ga") for a, b in ((x, y), (f"{x}z", f"{y}z"))
    }
    plan = rules._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("_there") and "inline(filter" in plan[plan.rindex("Aggregate [alpha") :]


def test_hot_bucket_is_dropped_whole(spark):
    """One bucket over the bound yields nothing, one at the bound yields all its pairs."""
    at = [(f"{c}z", 10) for c in "ab" for _ in range(500)]
    rules = {(r.alpha, r.beta): r.support for r in dust.likely_rules(size_log(spark, at), "head").collect()}
    assert rules == {("a", "b"): 250_000, ("b", "a"): 250_000}
    assert dust.likely_rules(size_log(spark, at + [("az", 10)]), "head").count() == 0
    assert [tuple(r) for r in dust.overflow(size_log(spark, at + [("az", 10)]), "head").collect()] == [("", "", 1001)]
    whole = dust.overflow(size_log(spark, at + [("az", 10)])).collect()
    assert {tuple(r) for r in whole} == {("", "", 1001), ("", "z", 1001)}
    assert dust.overflow(size_log(spark, at)).count() == 0


def test_rows_without_size_are_no_pages(spark):
    rows = [("ab/x", 10), ("cb/x", 10), ("db/x", 0), ("eb/x", None)]
    rules = {(r.alpha, r.beta) for r in dust.likely_rules(size_log(spark, rows), "head").collect()}
    assert {a for a, _ in rules if len(a) == 1} == {"a", "c"}


def sequential(rules, refines, window=50):
    """The elimination as one pass over the list."""
    gone = set()
    for i, (a, b, support) in enumerate(rules):
        if i in gone:
            continue
        for j in range(i + 1, min(len(rules), i + window + 1)):
            a2, b2, support2 = rules[j]
            if support - support2 > max(6 - support, 10):
                break
            if refines(a, b, a2, b2):
                gone.add(j)
            elif refines(a2, b2, a, b):
                gone.add(i)
                break
    return sorted((b, a) for i, (a, b, _) in enumerate(rules) if i not in gone)


def replaced(a1, b1, a2, b2, literal=False):
    parts = a2.split(a1)
    for k in range(1, len(parts)):
        before, after = a1.join(parts[:k]), a1.join(parts[k:])
        if (a2[len(before):] if literal else before) + b1 + after == b2:
            return True
    return False


def refine(spark, a1, b1, a2, b2, reading="intent"):
    row = spark.createDataFrame([(a1, b1, a2, b2)], "a1 string, b1 string, a2 string, b2 string")
    return row.select(F.expr(dust.refines_sql("a1", "b1", "a2", "b2", reading))).first()[0]


@pytest.mark.parametrize(
    "args,expected",
    [
        (("a", "b", "xay", "xby"), True),
        (("xay", "xby", "a", "b"), False),
        (("a", "b", "aa", "ba"), True),
        (("a", "b", "aa", "ab"), True),
        (("a", "b", "aa", "bb"), False),
        (("aa", "b", "aaa", "ba"), True),
        (("aa", "b", "aaa", "ab"), False),  # overlapping occurrence
        (("?", ".", "x?", "x."), True),  # text, not a pattern
    ],
)
def test_refines(spark, args, expected):
    assert refine(spark, *args) is expected
    assert replaced(*args) is expected


def test_refines_literal(spark):
    assert refine(spark, "a", "b", "xay", "xby", "literal") is False
    assert refine(spark, "a", "b", "xay", "ayby", "literal") is True


rule_lists = st.lists(
    st.tuples(
        st.text("ab", min_size=1, max_size=4),
        st.text("ab", min_size=1, max_size=4),
        st.integers(1, 40),
    ).filter(lambda r: r[0] != r[1]),
    min_size=1,
    max_size=150,
    unique_by=lambda r: r[:2],
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rule_lists, st.sampled_from(["asc", "desc"]), st.sampled_from(["intent", "literal"]))
def test_elimination_against_one_pass(spark, rules, order, reading):
    frame = spark.createDataFrame(rules, "alpha string, beta string, support long")
    got = dust.eliminate_redundant(dust.ranked_rules(frame, order), reading).collect()
    sign = 1 if order == "asc" else -1
    in_order = sorted(rules, key=lambda r: (sign * r[2], r[0], r[1]))
    want = sequential(in_order, lambda *r: replaced(*r, literal=reading == "literal"))
    assert sorted((r.beta, r.alpha) for r in got) == want


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rule_lists, st.sampled_from(["asc", "desc"]), st.sampled_from(["intent", "literal"]))
def test_elimination_without_window(spark, rules, order, reading):
    frame = spark.createDataFrame(rules, "alpha string, beta string, support long")
    got = dust.eliminate_redundant(dust.ranked_rules(frame, order), reading, window=None).collect()
    sign = 1 if order == "asc" else -1
    in_order = sorted(rules, key=lambda r: (sign * r[2], r[0], r[1]))
    want = sequential(in_order, lambda *r: replaced(*r, literal=reading == "literal"), window=len(rules))
    assert sorted((r.beta, r.alpha) for r in got) == want


def test_far_rules_are_compared(spark):
    """A short rule that comes from 300 positions away, and a list without any rules."""
    rules = [("a", "b", 1), *[(f"{k:03}", f"<{k}>{k}", 2) for k in range(300)], ("xa", "xb", 3), ("xay", "xby", 4)]
    frame = spark.createDataFrame(rules, "alpha string, beta string, support long")
    want = sequential(rules, replaced, window=len(rules))
    assert ("xb", "xa") not in want
    got = dust.eliminate_redundant(dust.ranked_rules(frame), window=None).collect()
    assert [(r.beta, r.alpha) for r in got] == want
    near = dust.eliminate_redundant(dust.ranked_rules(frame)).collect()
    assert ("xb", "xa") in [(r.beta, r.alpha) for r in near]
    assert dust.eliminate_redundant(dust.ranked_rules(frame.limit(0)), window=None).collect() == []


def test_rules_are_dealt_once_before_they_name_others(spark):
    """Rules and those they refine change the same text, so what a rule names is not shuffled."""
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("ab/") for _ in range(rng.randint(1, n)))
    rows = []
    for k in range(400):
        a, b, x, y = text(4), text(4), text(4), text(4)
        rows += [(k, a, b), (k, x + a + y, x + b + y)] if a != b else []
    found = dust._with_core(spark.createDataFrame(rows, "k int, alpha string, beta string"))
    assert found.groupBy("k").agg(F.countDistinct("_core").alias("n")).where("n > 1").count() == 0
    assert found.select("_core").distinct().count() > 50
    ranked = found.select(F.col("k").cast("long").alias("pos"), "alpha", "beta", F.lit(1).cast("long").alias("support"))
    plan = dust.all_refinements(ranked)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_elimination_over_block_borders(spark, monkeypatch):
    """Blocks far smaller than the list change nothing."""
    rng = random.Random(3)
    names = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) for _ in range(3000)]
    pairs = {(a, b) for a, b in zip(names, reversed(names)) if a != b}
    rules = [(a, b, rng.randint(1, 5)) for a, b in sorted(pairs)]
    frame = spark.createDataFrame(rules, "alpha string, beta string, support long")
    want = sequential(sorted(rules, key=lambda r: (r[2], r[0], r[1])), replaced)
    monkeypatch.setattr(dust, "ELIMINATION_BLOCK", 100)
    got = dust.eliminate_redundant(dust.ranked_rules(frame)).collect()
    assert [(r.beta, r.alpha) for r in got] == want


def near_pairs(rules, literal):
    """All pairs within 50 positions of which one refines the other."""
    found = set()
    for i, (a, b, support) in enumerate(rules):
        for j in range(i + 1, min(len(rules), i + 51)):
            a2, b2, support2 = rules[j]
            inside = (a in a2 and b in b2) or (a2 in a and b2 in b)
            if inside and support - support2 <= max(6 - support, 10):
                if replaced(a, b, a2, b2, literal):
                    found.add((i, j, "fwd"))
                elif replaced(a2, b2, a, b, literal):
                    found.add((i, j, "bwd"))
    return found


@pytest.mark.parametrize("reading", ["intent", "literal"])
@pytest.mark.parametrize("batch", [7, 1000])
def test_neighbours_meet_without_a_shuffle(spark, reading, batch):
    """Rules stored in order are compared where they are read; only the ends of runs are joined."""
    rng = random.Random(5)
    text = lambda: "".join(rng.choice("abé/") for _ in range(rng.randint(1, 4)))
    rules = sorted({(text(), text()): rng.randint(1, 3) for _ in range(2500)}.items(), key=lambda r: (r[1], *r[0]))
    rules = [(a, b, n) for (a, b), n in rules if a != b]
    want = near_pairs(rules, reading == "literal")
    assert len(want) > 20
    rows = [(i, *r) for i, r in enumerate(rules)]
    schema = "pos long, alpha string, beta string, support long"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        ordered = spark.createDataFrame(rows, schema).repartitionByRange(3, "pos").sortWithinPartitions("pos")
        mixed = spark.createDataFrame(rng.sample(rows, len(rows)), schema)
        for ranked in (ordered, mixed):
            got = dust.refinements(ranked, reading)
            assert {tuple(r) for r in got.collect()} == want
            assert got.count() == len(want)
        types = ", ".join(f"{c}_{side} {t}" for side in "ij" for c, t in ordered.dtypes)
        found = ordered.mapInArrow(dust._neighbours(reading), f"{types}, run long")
        assert found.where("pos_j is null").count() <= 3 * 100
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def rewritten(url, rules):
    idle = 0
    for i in range(MAX_STEPS):
        alpha, beta = rules[i % len(rules)]
        fresh = url.replace(alpha, beta)
        idle = idle + 1 if fresh == url else 0
        url = fresh
        if idle == len(rules):
            break
    return url


def test_apply_rules(spark):
    rng = random.Random(5)
    rules = [("aa", "b"), ("bb", "a"), ("ab", "ba"), ("c", "cc"), (".", "!"), ("drop", "--filtered--")]
    urls = ["".join(rng.choice("abc.") for _ in range(8)) for _ in range(60)] + ["drop", "xdrop"]
    urls = [u for u in urls if "c" not in u] + ["cb"]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], "pos int, alpha string, beta string")
    got = apply_rules(spark.createDataFrame([(u,) for u in urls], "url string"), frame).collect()
    want = {u: rewritten(u, rules) for u in urls}
    assert {r.url: r.canonical_url for r in got} == {
        u: v for u, v in want.items() if v != "--filtered--"
    }
    assert "drop" not in {r.url for r in got}


def test_apply_without_rules(spark):
    frame = spark.createDataFrame([], "pos int, alpha string, beta string")
    got = apply_rules(spark.createDataFrame([("u",)], "url string"), frame).collect()
    assert [(r.url, r.canonical_url) for r in got] == [("u", "u")]


def test_mined_rules_apply_after_the_sink(spark, tmp_path):
    log = size_log(spark, SIX)
    write_rules(dust.mine_rules(log), f"{tmp_path}/rules")
    mined = spark.read.parquet(f"{tmp_path}/rules")
    rules = one_direction(mined)
    pairs = {(r.alpha, r.beta) for r in rules.collect()}
    assert pairs and not pairs & {(b, a) for a, b in pairs}
    assert {frozenset(p) for p in pairs} == {frozenset(r) for r in mined.select("alpha", "beta").collect()}
    got = apply_rules(log.select("url"), rules).collect()
    assert len(got) == len(SIX)
    assert len({r.canonical_url for r in got}) < len(SIX)


def test_more_than_the_default_steps(spark):
    rules = [(f"<{k}>", f"<{k + 1}>") for k in range(150)]
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rules)], "pos int, alpha string, beta string")
    url = spark.createDataFrame([("<0>",)], "url string")
    assert apply_rules(url, frame, max_steps=400).first().canonical_url == "<150>"
    assert apply_rules(url, frame).first().canonical_url == "<100>"


def all_rewritten(url, rules, keep_host=False):
    """Rounds over the rules that a round begins with, of equal alphas the first."""
    host = re.match("[a-z]+://[^/?#]*|", url).group() if keep_host else ""
    first = {}
    for alpha, beta in rules:
        if (len(beta), beta) < (len(alpha), alpha):
            first.setdefault(alpha, beta)
    rest = url[len(host) :]
    while due := [(a, b) for a, b in first.items() if a in rest]:
        for alpha, beta in due:
            rest = rest.replace(alpha, beta)
    return host + rest


def test_all_rules_apply(spark):
    rng = random.Random(6)
    chain = [(f"<{k}>", f"<{k + 1}>") for k in range(400)]
    words = lambda n: "".join(rng.choices("abc", k=rng.randrange(n)))
    mixed = [(words(4), words(4)) for _ in range(300)]
    few = [(words(4), words(3)) for _ in range(8)]
    urls = ["".join(rng.choices("abc", k=30)) for _ in range(40)] + ["<0>", "<399>x", "<9>", "", "--filtered--drop", "http://abc/abcabc", "http://abc?aab"]
    urls += urls[:3]
    for rules in (chain, chain[::-1], mixed, few, [*few, ("drop", "")]):
        frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rules)], "pos int, alpha string, beta string")
        for keep_host in (True, False):
            given_urls = spark.createDataFrame([(u, 1) for u in urls], "url string, pos int")
            got = apply_decreasing(given_urls, frame, keep_host=keep_host).collect()
            want = [(u, 1, all_rewritten(u, rules, keep_host)) for u in urls]
            assert sorted(map(tuple, got)) == sorted(w for w in want if w[2] != "--filtered--")
            assert all(len(r.canonical_url) <= len(r.url) for r in got)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("ab", max_size=3), st.text("ab", max_size=3)), max_size=12), st.lists(st.text("ab", max_size=12), min_size=1, max_size=8))
def test_any_rules_end(spark, rules, urls):
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rules)], "pos int, alpha string, beta string")
    got = apply_decreasing(spark.createDataFrame([(u,) for u in urls], "url string"), frame).collect()
    assert sorted(map(tuple, got)) == sorted((u, all_rewritten(u, rules)) for u in urls)


def test_rules_in_circles_and_without_end(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("xc",), (None,)], "url string")
    frame = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "cc"), ("", "z"), (None, "a"), ("x", None)], "alpha string, beta string")
    got = {r.url: r.canonical_url for r in apply_decreasing(urls, frame).collect()}
    assert got == {"a": "a", "b": "a", "xc": "xc"}
    assert apply_decreasing(urls, frame.where("false")).count() == 3
    assert apply_decreasing(urls.where("false"), frame).count() == 0


def test_mined_rules_are_all_applied(spark):
    from crawlflow.plans import inputs
    from crawlflow.plans.catalogue import APPLIED_SUPPORT, QUERIES

    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rules = dust.mine_supported_rules(page_sizes(pages))
    assert {(r.alpha, r.beta) for r in rules.collect()} == {(r.alpha, r.beta) for r in dust.mine_rules(page_sizes(pages)).collect()}
    log = page_sizes(inputs.spelled(pages))
    rules = dust.mine_supported_rules(log, size_percent=20, order="desc", min_support=APPLIED_SUPPORT, only=decreasing)
    listed = rules.orderBy("pos", "beta", "alpha").collect()
    assert listed and all(r.support >= APPLIED_SUPPORT for r in listed)
    got = QUERIES["dust_apply_mined"](spark, sf).collect()
    assert len(got) == log.count()
    assert len({r.canonical_url for r in got}) < len({r.url for r in got})
    pairs = [(r.alpha, r.beta) for r in listed]
    assert all(r.canonical_url == all_rewritten(r.url, pairs, keep_host=True) for r in got)


@pytest.mark.parametrize("scope,size_percent", [("full", None), ("full", 20), ("head", None)])
def test_support_in_overflowing_buckets(spark, scope, size_percent):
    rng = random.Random(7)
    parts = ["", "a", "b", "ab", "www.", "index"]
    urls = [(rng.choice(parts) + rng.choice(parts) + "/x" + rng.choice(parts), rng.randrange(1, 40)) for _ in range(150)]
    log = spark.createDataFrame(urls, "url string, size int")
    rules = lambda **kw: {(r.alpha, r.beta): r.support for r in dust.likely_rules(log, scope, size_percent, **kw).collect()}
    everything = rules(max_bucket=10**9)
    few = rules(max_bucket=12)
    got = rules(max_bucket=12, count_overflow=True)
    assert got == {k: everything[k] for k in few}
    assert few and few != got


def bounded_rules(rows, max_bucket):
    """Rules of the buckets of at most ``max_bucket`` rows, bucket by bucket."""
    found, votes = {}, {}
    for line, size in rows:
        for i in range(len(line)):
            for j in range(i + 1, min(i + 12, len(line)) + 1):
                found.setdefault((line[:i], line[j:]), []).append((line[i:j], size))
    for members in found.values():
        for a, x in members if len(members) <= max_bucket else []:
            for b, y in members:
                if a != b and y < 2 * x:
                    votes[a, b] = votes.get((a, b), 0) + 1
    return votes


@pytest.mark.parametrize("max_bucket", [4, 9])
def test_rules_where_some_wider_or_narrower_buckets_are_full(spark, max_bucket):
    rng = random.Random(max_bucket)
    rows = [("".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) + rng.choice(["", "/index.html", "c"]), rng.randint(1, 60)) for _ in range(70)]
    got = dust.likely_rules(size_log(spark, rows), max_bucket=max_bucket).collect()
    expected = bounded_rules(rows, max_bucket)
    assert expected and {(r.alpha, r.beta): r.support for r in got} == expected and len(got) == len(expected)


def test_a_pair_of_lines_is_shuffled_once(spark, monkeypatch):
    """Two lines that are together in 72 buckets (up to 8 characters of text after, 12 in all) make one row, which gets the text around it after the shuffle."""
    sent, deal = [], dust._in_all_buckets
    monkeypatch.setattr(dust, "_in_all_buckets", lambda pairs: sent.append(pairs) or deal(pairs))
    rules = dust.likely_rules(size_log(spark, [("http://a.example/de/4163.html", 10), ("http://a.example/de/5163.html", 10)]))
    assert rules.count() == 2 * 72 and {r.support for r in rules.collect()} == {1}
    assert [(r.alpha, r.beta) for r in sent[0].collect()] == [("4", "5")]


def test_rules_are_summed_once_with_overflow(spark, monkeypatch):
    """What full buckets add joins the sums of pairs; the rules are neither written nor summed a second time."""
    written, materialize = [], dust.materialize
    monkeypatch.setattr(dust, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    rows = [(f"{c}{k}z", 10) for c in "ab" for k in range(9)]
    rules = dust.likely_rules(size_log(spark, rows), max_bucket=12, count_overflow=True)
    assert rules.count() > 0
    assert "overflow_members" in written and "proposed_rules" not in written
    assert rules._jdf.queryExecution().optimizedPlan().toString().startswith("Generate inline")


@pytest.mark.parametrize("max_bucket", [3, 1000])
def test_cells_of_long_lines(spark, max_bucket):
    """Lines of many cells, shared at any offset; with a low bound most cells shuffle their rows."""
    rng = random.Random(11)
    parts = ["http://", "a.example", "/é", "/index", "?page=", "12", "3", "", "/en/"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randint(3, 6))), rng.randint(1, 60)) for _ in range(60)]
    got = dust.likely_rules(size_log(spark, rows), max_bucket=max_bucket, count_overflow=True).collect()
    expected = brute_rules(rows, "full", None)
    found = {(r.alpha, r.beta): r.support for r in got}
    assert found == {k: expected[k] for k in found}
    if max_bucket == 1000:
        assert found == expected
    assert found and len(got) == len(found)


def test_two_lines_are_dealt_by_line_once(spark):
    """Only the first member of a pair needs the wider buckets of its line; the second goes to its bucket directly."""
    rows = [(f"http://a.example/de/{k}163.html", 10) for k in range(1, 5)]
    plan = dust.likely_rules(size_log(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [line") == 1


@pytest.mark.parametrize("cores", [1, 64])
def test_pairs_travel_as_one_text(spark, monkeypatch, cores):
    """A pair takes one text and small numbers to the task of its change, whatever its characters are."""
    monkeypatch.setattr(dust, "CORES_A_TASK", cores)
    rng = random.Random(cores)
    rows = [("".join(rng.choice("aé\n/😀") for _ in range(rng.randint(1, 14))), rng.randint(1, 60)) for _ in range(60)]
    rules = dust.likely_rules(size_log(spark, rows))
    assert {(r.alpha, r.beta): r.support for r in rules.collect()} == brute_rules(rows, "full", None)
    sent = [line for line in rules._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RepartitionByExpression [_core" in line]
    assert len(sent) == 1


def test_rules_are_stored_and_sorted_in_blocks(spark, monkeypatch):
    """Ranking and the final order, over many small ranges and blocks, give what a plain sort gives."""
    from crawlflow.operators import ranges

    for name, value in (("ROWS_A_RANGE", 50), ("ROWS_PACKED", 90), ("ROWS_SENT", 7)):
        monkeypatch.setattr(ranges, name, value)
    rng = random.Random(4)
    text = lambda: "".join(rng.choice("abé/") for _ in range(rng.randint(1, 4)))
    found = {(text(), text()): rng.randint(1, 3) for _ in range(1500)}
    rules = [(a, b, n) for (a, b), n in found.items() if a != b]
    frame = spark.createDataFrame(rules, "alpha string, beta string, support long").repartition(5)
    for order, sign in (("asc", 1), ("desc", -1)):
        want = sorted(rules, key=lambda r: (sign * r[2], r[0].encode(), r[1].encode()))
        ranked = dust.ranked_rules(frame, order)
        assert sorted((r.pos, r.alpha, r.beta, r.support) for r in ranked.collect()) == [(i, *r) for i, r in enumerate(want)]
        assert ranked.select("_part" if "_part" in ranked.columns else F.spark_partition_id()).distinct().count() > 1
        got = [(r.beta, r.alpha) for r in dust.eliminate_redundant(ranked).collect()]
        assert got == sequential(want, replaced)


def test_only_spans_between_common_ends_are_looked_at(spark):
    """What a rule may come from, against all spans of alpha; alphas of more than 12 characters lose none."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abé") for _ in range(rng.randint(0, n)))
    rules = [(x + text(3) + y, x + text(3) + y) for x, y in ((text(7), text(7)) for _ in range(200))] + [("", "a"), ("a", ""), ("a", "a")]

    def origins(a, b):
        found = set()
        for s in range(len(a)):
            for e in range(s + 1, len(a) + 1):
                x, y = a[:s], a[e:]
                if len(b) >= len(x + y) and b.startswith(x) and b.endswith(y):
                    found.add((a[s:e], b[len(x) : len(b) - len(y)]))
        return found - {(a, b)}

    frame = spark.createDataFrame(rules, "alpha string, beta string").withColumn("o", F.expr(dust._origins_sql("intent")))
    for row in frame.collect():
        got = [tuple(o) for o in row.o]
        assert len(got) == len(set(got)) and set(got) == origins(row.alpha, row.beta)
    plan = frame._jdf.queryExecution().analyzed().toString()
    assert "_same_end" in plan
