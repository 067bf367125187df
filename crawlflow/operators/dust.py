"""Mining of rewrite rules that map a URL to a probable duplicate.

Only URLs and page sizes are read, never page contents. Two substrings found inside the same
envelope (same text before and after) on pages of similar size vote for a rule alpha -> beta.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, Window as W

from crawlflow.operators.ranges import in_ranges, range_starts
from crawlflow.operators.sequence import with_position_compact
from crawlflow.session import materialize, materialize_compact, once, scratch_path, spread

# Fixed values of the method.
MAX_SUBSTRING = 12
MAX_BUCKET = 1000
WINDOW = 50
MAX_RELATIVE_DEFICIENCY = 6
MAX_ABSOLUTE_DEFICIENCY = 10

#: How many of the fullest overflowing buckets are dropped before the shuffle. What is
#: broadcast has at most this many rows; the buckets left hold at most 1/HOT of all rows each.
HOT_BUCKETS = 10_000

#: Characters by which the ends of envelopes are rounded to find lines that can share one.
CELL = 4

#: Positions resolved per group in the elimination step.
ELIMINATION_BLOCK = 20_000

#: Rules for each task when all are compared; they name some ten times as many, which a task should hold.
CORE_ROWS = 250_000

#: Changes of text are told apart by so many numbers for each task; only how even the tasks are depends on it.
CORES_A_TASK = 64

#: Pairs of substrings whose rules a task sums; a table of that many sums fits into its memory.
PAIRS_A_TASK = 1_000_000

#: Never part of a URL, as the size log has one URL per line.
MARK = "\n"


def examined(size_log: DataFrame, scope: str = "full") -> DataFrame:
    """``(line, size)``: the examined part of each URL.

    ``full`` examines the whole URL, ``head`` only the first min(length - 1, 12) characters. A row
    without a positive size is no page.
    """
    line = F.col("url")
    if scope == "head":
        line = F.expr(f"substring(url, 1, least(length(url) - 1, {MAX_SUBSTRING}))")
    elif scope != "full":
        raise ValueError(f"scope must be 'head' or 'full', not {scope!r}")
    return size_log.where("size > 0").select(line.alias("line"), "size").where("length(line) > 0")


def merged_lines(size_log: DataFrame, scope: str = "full") -> DataFrame:
    """``(line, size, m)``: equal rows merged to one with their number, before any explosion."""
    return examined(size_log, scope).groupBy("line", "size").agg(F.count("*").alias("m"))


def explode_envelopes(lines: DataFrame) -> DataFrame:
    """All substrings of ``line`` up to 12 characters, each with its prefix and suffix."""
    kept = [c for c in lines.columns if c != "line"]
    return (
        lines.select(
            "line",
            *kept,
            F.explode(F.expr(f"sequence(1, least(length(line), {MAX_SUBSTRING}))")).alias("_len"),
        )
        .select("*", F.explode(F.expr("sequence(1, length(line) - _len + 1)")).alias("_at"))
        .select(
            F.expr("substring(line, 1, _at - 1)").alias("prefix"),
            F.expr("substring(line, _at + _len)").alias("suffix"),
            F.expr("substring(line, _at, _len)").alias("substr"),
            *kept,
        )
    )


def envelopes(size_log: DataFrame, scope: str = "full") -> DataFrame:
    """``(prefix, suffix, substr, size)``, one row per substring occurrence of every URL."""
    return explode_envelopes(examined(size_log, scope))


def _bucket_sizes(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("m").alias("n"))


def buckets(size_log: DataFrame, scope: str = "full") -> DataFrame:
    """Buckets that may yield rules: more than one and at most 1000 rows."""
    rows = explode_envelopes(merged_lines(size_log, scope))
    return _bucket_sizes(rows, ["prefix", "suffix"]).where(f"n between 2 and {MAX_BUCKET}")


def overflow(size_log: DataFrame, scope: str = "full") -> DataFrame:
    """``(prefix, suffix, n)`` of the buckets over the bound of the method, which yield no rules."""
    rows = explode_envelopes(merged_lines(size_log, scope))
    return _bucket_sizes(rows, ["prefix", "suffix"]).where(f"n > {MAX_BUCKET}")


def _cells(lines: DataFrame) -> DataFrame:
    """``lines`` once for each cell: the envelopes whose prefix and suffix agree when cut to cells.

    A cell is named by the prefix and suffix cut to multiples of ``CELL`` characters, so equal envelopes
    are in the same cell. A line has some 40 cells where it has 450 envelopes.
    """
    shortest = f"greatest(length(line) - {MAX_SUBSTRING}, 0)"
    lowest = f"greatest({shortest} - {2 * (CELL - 1)} - _i, 0)"
    return (
        lines.select("*", F.explode(F.expr(f"sequence(0, length(line) - 1, {CELL})")).alias("_i"))
        .withColumn("_from", F.expr(f"(({lowest} + {CELL - 1}) div {CELL}) * {CELL}"))
        .withColumn("_to", F.expr("length(line) - 1 - _i"))
        .withColumn(
            "_j", F.explode(F.expr(f"if(_from <= _to, sequence(_from, greatest(_from, _to), {CELL}L), array())"))
        )
        .drop("_from", "_to")
        .withColumn("_cell", F.expr("xxhash64(substring(line, 1, _i), substring(line, -_j, _j))"))
    )


def _cell_lines(lines: DataFrame, max_bucket: int) -> DataFrame:
    """``(line, size, m, _i, _j, _cell, full)`` for cells that hold several lines; all others make no pair.

    ``full`` cells have more than ``max_bucket`` rows. Only hashes and counts are shuffled to find out.
    """
    named = _cells(lines).select("_cell", "m", F.xxhash64("line").alias("_name"))
    shared = (
        named.groupBy("_cell")
        .agg(F.sum("m").alias("n"), (F.min("_name") != F.max("_name")).alias("varied"))
        .where("varied")
        .select("_cell", F.expr(f"n > {max_bucket}").alias("full"))
    )
    return materialize(_cells(lines).join(materialize(shared, "cells"), "_cell"), "cell_lines")


def _cell_rows(cell_lines: DataFrame, scope: str) -> tuple[DataFrame, list[str]]:
    """The exploded rows of cells, with ``_cell``, the ``line`` with the place ``_at`` of its substring, and the
    columns that identify their bucket.

    Whole-URL envelopes are long, so there the bucket is named by two 64-bit hashes and the
    envelope text does not travel through the shuffles.
    """
    rows = (
        cell_lines.select("*", F.explode(F.expr(f"sequence(0L, {CELL - 1}L)")).alias("_di"))
        .select("*", F.explode(F.expr(f"sequence(0L, {CELL - 1}L)")).alias("_dj"))
        .withColumn("_len", F.expr("length(line) - _i - _di - _j - _dj"))
        .where(f"_len between 1 and {MAX_SUBSTRING}")
        .withColumn("_at", F.expr("int(_i + _di)"))
        .withColumn("prefix", F.expr("substring(line, 1, _at)"))
        .withColumn("suffix", F.expr("substring(line, int(_at + _len + 1))"))
        .withColumn("substr", F.expr("substring(line, _at + 1, int(_len))"))
    )
    if scope == "head":
        return rows.select("_cell", "prefix", "suffix", "line", "_at", "substr", "size", "m"), ["prefix", "suffix"]
    hashed = rows.select(
        "_cell",
        F.xxhash64("prefix", "suffix").alias("env_a"),
        F.xxhash64("suffix", F.lit("|"), "prefix").alias("env_b"),
        "line",
        "_at",
        "substr",
        "size",
        "m",
    )
    return hashed, ["env_a", "env_b"]


def _bucket_substrings(
    lines: DataFrame, scope: str, max_bucket: int = MAX_BUCKET
) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """Usable buckets as one row per substring with its line and the sizes of its pages; sizes and rows of full cells.

    A usable bucket has at most 1000 rows, or ``max_bucket``, which bounds every collected list. Buckets with one
    row or with equal substrings only are left out too, as they cannot make a pair; the latter
    show by equal minimum and maximum of the substrings' hashes.

    No bucket has more rows than its cell. The lines of a cell within the bound go to one task and are
    exploded there, so their envelopes are never shuffled. Those of full cells are, by bucket.
    """
    cell_lines = _cell_lines(lines, max_bucket)
    rows, keys = _cell_rows(cell_lines.where("full"), scope)
    rows = rows.drop("_cell")
    within = cell_lines.where("not full")
    parts = int(within.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local, _ = _cell_rows(within.repartition(parts, "_cell"), scope)
    few = (
        local.groupBy("_cell", *keys, "substr", "line", "_at")
        .agg(F.collect_list(F.struct("size", "m")).alias("pages"))
        .groupBy("_cell", *keys)
        .agg(F.collect_list(F.struct("substr", "line", "_at", "pages")).alias("_subs"))
        .where("size(_subs) > 1")
        .select(*keys, F.inline("_subs"))
    )
    named = rows.withColumn("_name", F.xxhash64("substr"))
    sizes = named.groupBy(*keys).agg(
        F.sum("m").alias("n"), (F.min("_name") != F.max("_name")).alias("varied")
    )
    sizes = materialize(sizes.where(f"n > {max_bucket} or (n > 1 and varied)"), "bucket_sizes")
    # The fullest overflowing buckets leave first, through a bounded broadcast, so that no hot
    # bucket is ever sent to one task. The others are found by the semi join.
    hot = (
        sizes.where(f"n > {max_bucket}").orderBy(F.desc("n"), *keys).limit(HOT_BUCKETS).select(*keys)
    )
    usable = sizes.where(f"n <= {max_bucket}").select(*keys)
    members = (
        rows.join(F.broadcast(hot), keys, "left_anti")
        .join(usable, keys, "left_semi")
        .groupBy(*keys, "substr", "line", "_at")
        .agg(F.collect_list(F.struct("size", "m")).alias("pages"))
    )
    return materialize_compact(few.unionByName(members), "bucket_members"), sizes, rows, keys


def _with_reach(members: DataFrame) -> DataFrame:
    """Add the wider usable buckets of each member's line, which end farther to the left or start farther to the right.

    ``_reach`` has four bits for each number of characters by which the right side of the envelope is shorter: in how many usable
    buckets, one after the other, the left side can then be shortened character by character. ``_left`` and ``_right`` say
    whether the bucket with one more character on that side is usable. No substring has more than 12 characters.
    """
    row, column = W.partitionBy("line", "_end").orderBy("_at"), W.partitionBy("line", "_at").orderBy("_end")
    run = W.partitionBy("line", "_end", "_run").orderBy("_at")
    shorter = "transform(_wide, (w, k) -> if(_end - w._end = size(_wide) - 1 - k, shiftleft(w.n, 4 * (_end - w._end)), 0L))"
    return (
        members.withColumn("_end", F.expr("length(line) - _at - length(substr)"))
        .repartition("line")
        .withColumns({"_run": F.col("_at") - F.row_number().over(row), "_left": F.coalesce(F.lead("_at").over(row) == F.col("_at") + 1, F.lit(False))})
        .withColumn("_wide", F.struct("_end", F.row_number().over(run).cast("long").alias("n")))
        .withColumns({
            "_wide": F.collect_list("_wide").over(column.rowsBetween(1 - MAX_SUBSTRING, W.currentRow)),
            "_right": F.coalesce(F.lead("_end").over(column) == F.col("_end") + 1, F.lit(False)),
        })
        .withColumn("_reach", F.expr(f"aggregate({shorter}, 0L, (acc, x) -> acc | x)"))
        .withColumns({
            "before": F.expr(f"right(substring(line, 1, _at), {MAX_SUBSTRING - 1})"),
            "after": F.expr(f"substring(line, _at + length(substr) + 1, {MAX_SUBSTRING - 1})"),
        })
        .drop("_end", "_run", "_wide", "line", "_at")
    )


def _pairs(
    members: DataFrame, keys: list[str], size_percent: int | None, parts: int, also: str = "true", firsts: DataFrame | None = None
) -> DataFrame:
    """``(alpha, beta, _there, _back, ...)``: for each two substrings of a bucket the pairs of pages that show each direction.

    Of two substrings the shorter one is alpha, of equally long ones the smaller: so it is with equal text around them too.
    ``firsts`` are the members with more columns, which a pair has from its alpha.
    """
    firsts = members if firsts is None else firsts
    left = firsts.withColumnsRenamed({"substr": "alpha", "pages": "pages_a"})
    right = members.select(*keys, F.col("substr").alias("beta"), F.col("pages").alias("pages_b"))
    there, back = _pair_count_sql(size_percent), _pair_count_sql(size_percent, "pages_b", "pages_a")
    # A bucket's pairs are many more than its rows, by which adaptive execution would size the tasks.
    pairs = left.repartition(parts, *keys).join(right, keys).where(
        f"(length(alpha) < length(beta) or length(alpha) = length(beta) and alpha < beta) and ({also})"
    )
    named = ["alpha", "beta", *[c for c in firsts.columns if c not in (*keys, "substr", "pages", "line", "_at")]]
    if size_percent is None:
        # At least one of two sizes is less than twice the other.
        return pairs.select(*named, F.expr(there).alias("_there"), F.expr(back).alias("_back"))
    # Pairs that show no rule do not travel.
    counted = f"array(struct({', '.join(named)}, {there} as _there, {back} as _back))"
    return pairs.select(F.expr(f"inline(filter({counted}, r -> r._there > 0 or r._back > 0))"))


def _line_pairs(members: DataFrame, keys: list[str], size_percent: int | None, parts: int) -> DataFrame:
    """``(alpha, beta, before, after, _reach, _there, _back)``: pairs, each for many buckets that hold the same two lines.

    Two lines are together in the bucket of all text that they share around alpha and beta, and in wider ones, by the same
    pages. Of those that lie side by side only the narrowest makes the pair: where alpha and beta begin with the same
    character, a usable bucket with one more character on the left does; where they end with the same one and begin
    with others, one with more on the right.
    """
    short = "length(alpha) = 1"
    narrowest = f"""if(left(alpha, 1) = left(beta, 1), {short} or not _left,
        right(alpha, 1) <> right(beta, 1) or {short} or not _right)"""
    pairs = _pairs(members, keys, size_percent, parts, narrowest, _with_reach(members))
    reach = F.expr("if(left(alpha, 1) = left(beta, 1), _reach & 15, _reach)")
    room = f"int(greatest({MAX_SUBSTRING} - length(beta), 0))"
    return pairs.withColumns({"_reach": reach, "before": F.expr(f"right(before, {room})"), "after": F.expr(f"left(after, {room})")}).drop("_left", "_right")


def _in_all_buckets(pairs: DataFrame) -> DataFrame:
    """The pairs of ``_line_pairs`` with the text around them that they have in each bucket."""
    kept = [c for c in pairs.columns if c not in ("alpha", "beta", "before", "after", "_reach")]
    whole = pairs.selectExpr(
        *kept, "_reach", "concat(before, alpha, after) as _a", "concat(before, beta, after) as _b",
        "length(before) as _from", "length(alpha) as _la", "length(beta) as _lb", f"{MAX_SUBSTRING} - length(beta) as _room",
    )
    return (
        whole.select("*", F.explode(F.expr("sequence(0, _room)")).alias("_r"))
        .withColumn("_n", F.expr("least(int(shiftright(_reach, 4 * _r) & 15), _room - _r + 1)"))
        .select("*", F.explode(F.expr(f"slice(sequence(0, {MAX_SUBSTRING - 1}), 1, _n)")).alias("_l"))
        .selectExpr(
            "substring(_a, _from - _l + 1, _la + _l + _r) as alpha", "substring(_b, _from - _l + 1, _lb + _l + _r) as beta", *kept
        )
    )


def _overflow_pairs(
    members: DataFrame, rows: DataFrame, keys: list[str], sizes: DataFrame, max_bucket: int, size_percent: int | None, parts: int
) -> DataFrame:
    """``(alpha, beta, _there, _back)`` in buckets over the bound, of pairs that a usable bucket holds too.

    No pairs are formed there: a substring of a bucket has one histogram of sizes, and only those
    that a pair of a usable bucket names meet, first its alpha and then its beta. Such pairs are looked for
    among the substrings found in both kinds of buckets, a small part of the members.
    """
    over = sizes.where(f"n > {max_bucket} and varied").select(*keys)
    histograms = materialize(
        rows.join(over, keys, "left_semi")
        .join(members.select("substr").distinct(), "substr", "left_semi")
        .groupBy(*keys, "substr", "size")
        .agg(F.sum("m").alias("m"))
        .groupBy(*keys, "substr")
        .agg(F.collect_list(F.struct("size", "m")).alias("pages")),
        "overflow_members",
    )
    both = materialize(members.join(histograms.select("substr").distinct(), "substr", "left_semi"), "members_of_both")
    named = _pairs(both, keys, size_percent, parts).select("alpha", "beta").distinct()
    left = histograms.select(*keys, F.col("substr").alias("alpha"), F.col("pages").alias("pages_a"))
    right = histograms.select(*keys, F.col("substr").alias("beta"), F.col("pages").alias("pages_b"))
    there, back = _pair_count_sql(size_percent), _pair_count_sql(size_percent, "pages_b", "pages_a")
    return (
        left.join(named, "alpha")
        .join(right, [*keys, "beta"])
        .groupBy("alpha", "beta")
        .agg(F.sum(F.expr(there)).alias("_there"), F.sum(F.expr(back)).alias("_back"))
    )


def _pair_count_sql(size_percent: int | None, a: str = "pages_a", b: str = "pages_b") -> str:
    """SQL counting the similar pairs of the page lists ``a`` and ``b`` by one merge.

    Both lists are put on one scale and sorted together. Walking along, ``seen`` counts the pages
    of b so far; the upper limit of a page of a adds it, the lower limit takes it off again. This
    costs the sum of the list lengths instead of their product. Two single pages, by far the most
    frequent case when whole URLs are examined, are compared directly.
    """
    scale, upper, lower = (1, 2, None) if size_percent is None else (100, 100 + size_percent, 100 - size_percent)
    events = [
        f"transform({a}, p -> struct({upper}L * p.size as at, 0 as kind, p.m as w))",
        f"transform({b}, p -> struct({scale}L * p.size as at, 1 as kind, p.m as w))",
    ]
    if lower is not None:
        events.append(f"transform({a}, p -> struct({lower}L * p.size as at, 2 as kind, -p.m as w))")
    merge = (
        f"aggregate(array_sort(concat({', '.join(events)})), struct(0L as seen, 0L as pairs), "
        "(acc, e) -> struct("
        "acc.seen + if(e.kind = 1, e.w, 0L) as seen, "
        "acc.pairs + if(e.kind = 1, 0L, e.w * acc.seen) as pairs), acc -> acc.pairs)"
    )
    size_a, size_b = f"{a}[0].size", f"{scale}L * {b}[0].size"
    similar = f"{size_b} < {upper}L * {size_a}"
    if lower is not None:
        similar += f" and {size_b} > {lower}L * {size_a}"
    single = f"if({similar}, {a}[0].m * {b}[0].m, 0L)"
    return f"if(size({a}) = 1 and size({b}) = 1, {single}, {merge})"


def likely_rules(
    size_log: DataFrame, scope: str = "full", size_percent: int | None = None,
    max_bucket: int = MAX_BUCKET, count_overflow: bool = False,
) -> DataFrame:
    """``(alpha, beta, support)``: support counts the URL pairs that show the rule.

    ``size_percent=None`` keeps the integer division of the original test, by which a pair
    passes when ``size_beta < 2 * size_alpha``. A number asks that the sizes differ by less than
    that percentage of ``size_alpha``.

    The examined lines, the bucket sizes and the bucket members are written once each, so the
    page table is read once. Inside a bucket the join pairs substrings, not pages.

    Buckets of more than ``max_bucket`` rows propose no rules. With ``count_overflow`` the rules that
    others propose get their support there too; without, as in the original, it is left out.
    """
    lines = spread(materialize(merged_lines(size_log, scope), "url_lines"), "line", "size")
    members, sizes, full_rows, keys = _bucket_substrings(lines, scope, max_bucket)
    n = F.col("count")
    made = members.groupBy(*keys).count().agg(F.sum(n * (n - 1) / 2)).head()[0] or 0
    parts = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(made // PAIRS_A_TASK) + 1)
    # Both directions of a pair travel and are summed as one row.
    pairs, there, back = _line_pairs(members, keys, size_percent, parts), "_there", "_back"
    if count_overflow:
        # What full buckets add is summed with the pairs and beside them, as it proposes nothing.
        more = _overflow_pairs(members, full_rows, keys, sizes, max_bucket, size_percent, parts)
        more = more.selectExpr("alpha", "beta", "'' as before", "'' as after", "1L as _reach", "0L as _there", "0L as _back", "_there as _more", "_back as _more_back")
        pairs = pairs.selectExpr("*", "0L as _more", "0L as _more_back").unionByName(more)
        there, back = "_there + _more", "_back + _more_back"
    sums = [c for c in pairs.columns if c.startswith(("_there", "_back", "_more"))]
    others = ["_reach", *sums]
    forth, reverse = f"struct(alpha, beta, {there} as support)", f"struct(beta as alpha, alpha as beta, {back} as support)"
    # Rules with the same change of text meet in one task, where a pair is given the text around it. They go by a
    # small number, few of which are in a task, and their texts go as one: a wide row is mostly gaps.
    small = F.expr(f"int(pmod(_core, {CORES_A_TASK * parts}))")
    text, cut = F.concat("alpha", "beta", "before", "after"), F.expr("int(length(alpha) + 16 * length(beta) + 256 * length(before))")
    sent = _with_core(pairs).select(text.alias("_text"), cut.alias("_cut"), *others, small.alias("_core"))
    got = sent.repartition(parts, "_core").withColumns({"_a": F.expr("_cut & 15"), "_b": F.expr("shiftright(_cut, 4) & 15"), "_c": F.expr("shiftright(_cut, 8)")})
    got = got.selectExpr(
        "left(_text, _a) as alpha", "substring(_text, _a + 1, _b) as beta", "substring(_text, _a + _b + 1, _c) as before",
        "substring(_text, _a + _b + _c + 1) as after", *others, "_core",
    )
    dealt = _in_all_buckets(got)
    return (
        dealt.groupBy("alpha", "beta", "_core")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            F.expr(f"""inline(case when _there > 0 and _back > 0 then array({forth}, {reverse})
                when _there > 0 then array({forth}) when _back > 0 then array({reverse}) end)""")
        )
    )


def ranked_rules(rules: DataFrame, order: str = "asc") -> DataFrame:
    """Rules with their 0-based ``pos`` in support order, ties by alpha and beta."""
    if order == "asc":
        return with_position_compact(rules, "support", "alpha", "beta").select(
            "pos", "alpha", "beta", "support"
        )
    if order == "desc":
        negated = rules.withColumn("_down", -F.col("support"))
        return with_position_compact(negated, "_down", "alpha", "beta").select(
            "pos", "alpha", "beta", "support"
        )
    raise ValueError(f"order must be 'asc' or 'desc', not {order!r}")


def refines_sql(a1: str, b1: str, a2: str, b2: str, reading: str = "intent") -> str:
    """SQL for: rule (a1, b1) refines rule (a2, b2).

    ``intent``: a1 occurs in a2 and putting b1 in place of one occurrence gives b2.
    ``literal``: what stands before b1 is the part of a2 that starts at the occurrence, as the
    original program computes it against its own description.
    Occurrences are those of a left-to-right scan without overlap.
    """
    parts = f"split(replace({a2}, {a1}, '{MARK}'), '{MARK}')"
    before = f"array_join(slice({parts}, 1, k), {a1})"
    after = f"array_join(slice({parts}, k + 1, size({parts})), {a1})"
    if reading == "literal":
        before = f"substring({a2}, length({before}) + 1)"
    elif reading != "intent":
        raise ValueError(f"reading must be 'intent' or 'literal', not {reading!r}")
    return (
        f"if(contains({a2}, {a1}), "
        f"exists(sequence(1, size({parts}) - 1), k -> concat({before}, {b1}, {after}) = {b2}), "
        f"false)"
    )


def _supported(earlier: str, later: str) -> str:
    """SQL for: the earlier rule's support does not exceed the later one's by too much."""
    return f"{earlier} - {later} <= greatest({MAX_RELATIVE_DEFICIENCY} - {earlier}, {MAX_ABSOLUTE_DEFICIENCY})"


def _common_sql(cut: str, a: str, b: str) -> str:
    """SQL for: how many characters, up to 12, are common to ``a`` and ``b`` at their left or right end (``cut``)."""
    lengths = range(1, MAX_SUBSTRING + 1)
    return "(" + " + ".join(f"int({k} <= least(length({a}), length({b})) and {cut}({a}, {k}) = {cut}({b}, {k}))" for k in lengths) + ")"


def _origins_sql(reading: str) -> str:
    """SQL array of the rules that ``(alpha, beta)`` may be a refinement result of, one for each span of alpha.

    If a span's surroundings (see ``refines_sql``) also enclose beta, what they enclose there is the
    beta of the only rule on that span that can give this one. Alpha has at most 12 characters,
    so there are at most 78 spans.
    """
    before = "substring(alpha, s)" if reading == "literal" else "substring(alpha, 1, s - 1)"
    after = "substring(alpha, e + 1)"
    outside = f"(length({before}) + length({after}))"
    origin = f"""if(length(beta) >= {outside} and startswith(beta, {before}) and endswith(beta, {after}),
        struct(substring(alpha, s, e - s + 1) as alpha,
               substring(beta, length({before}) + 1, length(beta) - {outside}) as beta), null)"""
    starts, ends = "sequence(1, length(alpha))", "sequence(s, length(alpha))"
    if reading == "intent":
        # What stands before a span and after it must be so in beta too: only spans for which it can be are looked at.
        start, end = _common_sql("left", "alpha", "beta"), _common_sql("right", "alpha", "beta")
        whole = f"greatest(length(alpha) - {MAX_SUBSTRING}, 0)"
        starts = f"sequence(1, least({start} + {whole} + 1, length(alpha)))"
        ends = f"sequence(greatest(s, length(alpha) - _same_end - {whole}), length(alpha))"
        return f"""if(length(alpha) = 0, array(), array_distinct(filter(flatten(transform(array({end}), _same_end ->
            flatten(transform({starts}, s -> transform({ends}, e -> {origin}))))),
            o -> o is not null and not (o.alpha = alpha and o.beta = beta))))"""
    spans = f"transform({starts}, s -> transform({ends}, e -> {origin}))"
    return f"""if(length(alpha) = 0, array(), array_distinct(filter(flatten({spans}),
        o -> o is not null and not (o.alpha = alpha and o.beta = beta))))"""


def _with_core(rules: DataFrame) -> DataFrame:
    """Add ``_core``, a hash of what a rule changes: alpha and beta without their common start, then without their common end.

    A rule and those it refines by intent differ in what surrounds both sides, so they agree here. Where one side
    is left empty, the other may be read off at several places, as rotations of one text: the least one stands.
    """

    def turned(text: str) -> str:
        turns = f"transform(sequence(1, length({text})), k -> concat(substring({text}, k), left({text}, k - 1)))"
        return f"if(length({text}) = 0, '', array_min({turns}))"

    columns = rules.columns
    cut = rules.selectExpr("*", "alpha as _a", "beta as _b").withColumn("_n", F.expr(_common_sql("left", "_a", "_b")))
    cut = cut.selectExpr(*columns, "substring(_a, _n + 1) as _a", "substring(_b, _n + 1) as _b").withColumn("_n", F.expr(_common_sql("right", "_a", "_b")))
    cut = cut.selectExpr(*columns, "left(_a, length(_a) - _n) as _a", "left(_b, length(_b) - _n) as _b")
    core = f"""if(length(_a) > 0 and length(_b) > 0, xxhash64(_a, '{MARK}', _b),
        xxhash64({turned('_a')}, '{MARK}', {turned('_b')}))"""
    return cut.withColumn("_core", F.expr(core)).drop("_a", "_b")


def all_refinements(ranked: DataFrame, reading: str = "intent") -> DataFrame:
    """``(pos_i, pos_j, kind, level)`` for all rules of which one refines the other, however far apart.

    Every rule names itself and the shorter rules it may come from, and meets those that are in the table: a running
    window over all that name one rule. By intent they all change the same text (``_with_core``), by which
    rules are dealt out before they name others, so what they name, many times the rules, is not shuffled.
    ``level`` is the length of the longer rule's alpha (of alpha and beta in the literal reading); along
    a chain of refinements it grows.
    """
    if reading not in ("intent", "literal"):
        raise ValueError(f"reading must be 'intent' or 'literal', not {reading!r}")
    rules = ranked.select("pos", "alpha", "beta", "support")
    keys = ["alpha_s", "beta_s"]
    if reading == "intent":
        # Rules that can refine one another go to one task, once; the rules they may come from are listed there.
        parts = int(ranked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(parts, -(-ranked.count() // CORE_ROWS))
        rules = _with_core(rules).repartition(parts, "_core")
        keys = ["_core", *keys]
    origins = f"concat(array(struct(alpha, beta)), {_origins_sql(reading)})"
    # Of the rows that name a rule its own comes first.
    own = F.expr("alpha = alpha_s and beta = beta_s")
    earlier = W.partitionBy(*keys).orderBy(own.desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    named = (
        rules.select("*", F.explode(once(F.expr(origins))).alias("_from"))
        .select(*rules.columns, F.col("_from.alpha").alias("alpha_s"), F.col("_from.beta").alias("beta_s"))
        .withColumn("_known", F.first(F.when(own, F.struct("pos", "support"))).over(earlier))
        .where(~own & F.col("_known").isNotNull())
        .withColumns({"pos_s": F.col("_known.pos"), "support_s": F.col("_known.support")})
    )
    level = "length(alpha) + length(beta)" if reading == "literal" else "length(alpha)"
    in_reach = f"if(pos_s < pos, {_supported('support_s', 'support')}, {_supported('support', 'support_s')})"
    return (
        named.where(f"{in_reach} and {refines_sql('alpha_s', 'beta_s', 'alpha', 'beta', reading)}")
        .select(
            F.least("pos", "pos_s").alias("pos_i"),
            F.greatest("pos", "pos_s").alias("pos_j"),
            F.expr("if(pos_s < pos, 'fwd', 'bwd')").alias("kind"),
            F.expr(level).alias("level"),
        )
    )


def eliminated_anywhere(pairs: DataFrame) -> DataFrame:
    """Positions of redundant rules by ``all_refinements``, decided level by level.

    A rule is eliminated by rules of lower levels only, so all rules of a level are decided at once:
    those that a rule not yet eliminated refines go. There are as many rounds as levels, at most 12
    (24 in the literal reading); each reads its own level's pairs and the positions gone so far.
    """
    spark = pairs.sparkSession
    path, gone = scratch_path(spark, "refinements"), scratch_path(spark, "eliminated")
    pairs.write.partitionBy("kind", "level").parquet(path)
    pairs = spark.read.schema("pos_i long, pos_j long, kind string, level int").parquet(path)
    stops = pairs.where("kind = 'bwd'").groupBy("pos_i").agg(F.min("pos_j").alias("_stop"))
    stops = materialize(stops.withColumnRenamed("pos_i", "pos"), "stops")
    effects = pairs.where("kind = 'fwd'").select(F.col("pos_i").alias("src"), F.col("pos_j").alias("dst"), "level")
    stops.select("pos").write.parquet(f"{gone}/level=0")
    # At most one row for each length of a rule.
    levels = sorted(row.level for row in effects.select("level").distinct().collect())
    for done, level in zip([0, *levels], levels):
        before = spark.read.schema("pos long, level int").parquet(gone).where(f"level between 1 and {done}")
        # What is gone eliminates nothing, as if it were stopped before all others.
        ends = stops.unionByName(before.select("pos", F.lit(-1).cast("long").alias("_stop")))
        ends = ends.groupBy(F.col("pos").alias("src")).agg(F.min("_stop").alias("_stop"))
        found = effects.where(F.col("level") == level).join(ends, "src", "left").where("_stop is null or dst < _stop")
        found.select(F.col("dst").alias("pos")).distinct().write.parquet(f"{gone}/level={level}")
    return spark.read.schema("pos long, level int").parquet(gone).select("pos").distinct()


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each text, and a 64-bit set of them. What a text contains has a subset of its bits."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], "int64")[texts.offset : texts.offset + len(texts) + 1]
    lengths = np.diff(ends)
    found = np.zeros(len(lengths), "uint64")
    if lengths.any():
        data = np.frombuffer(texts.buffers()[2], "uint8")[ends[0] : ends[-1]]
        bits = np.left_shift(np.uint64(1), (data & 63).astype("uint64"))
        some = lengths > 0
        found[some] = np.bitwise_or.reduceat(bits, (ends[:-1] - ends[0])[some])
    return lengths, found


def _may_refine(one: list[np.ndarray], two: list[np.ndarray], reading: str) -> np.ndarray:
    """Whether rule ``one`` can refine ``two``, as far as lengths and letters tell."""
    (la, ma, lb, mb), (la2, ma2, lb2, mb2) = one, two
    if reading == "intent":
        fits = (la < la2) & (lb - la == lb2 - la2)
        letters = mb
    else:
        twice = lb2 - la - lb
        fits = (la <= la2) & (twice >= 0) & (twice % 2 == 0) & (twice <= 2 * (la2 - la))
        letters = ma | mb
    return fits & (ma & ~ma2 == 0) & (letters & ~mb2 == 0)


def _neighbours(reading: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What ``refinements`` does with the rows of one task: candidate pairs, and the ends of runs.

    A run is a series of rows with successive positions. Of a run 50 rows are held at a time. A row that
    has no rule beside it is at the end of a run: its partners may be in other runs.
    """
    fields = ["pos", "alpha", "beta", "support"]

    def rows(left: pa.Table, right: pa.Table | None, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        columns = {f"{c}_i": left[c] for c in fields}
        columns |= {f"{c}_j": right[c] if right else pa.nulls(len(left), left.schema.field(c).type) for c in fields}
        yield from pa.table(columns | {"run": pa.array(run, pa.int64())}).to_batches(max_chunksize=100_000)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_runs = None, np.zeros(0, "int64")
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).select(fields)
            fresh = len(held_runs)
            table = (pa.concat_tables([held, table]) if fresh else table).combine_chunks()
            pos = table["pos"].to_numpy()
            # The run of a row is named by the run's first position.
            begins = np.flatnonzero(np.r_[True, np.diff(pos) != 1])
            run = np.repeat(pos[begins], np.diff(np.r_[begins, len(pos)]))
            if fresh:
                first = begins[1] if len(begins) > 1 else len(pos)
                run[:first] = held_runs[0]
            known = [*_letters(table["alpha"].combine_chunks()), *_letters(table["beta"].combine_chunks())]
            pairs = []
            for k in range(1, min(WINDOW, len(pos) - 1) + 1):
                low = max(fresh - k, 0)
                one, two = [x[low : len(pos) - k] for x in known], [x[low + k :] for x in known]
                near = _may_refine(one, two, reading) | _may_refine(two, one, reading)
                at = np.flatnonzero(near & (run[low : len(pos) - k] == run[low + k :])) + low
                pairs.append((at, at + k))
            if pairs:
                i, j = (np.concatenate(x) for x in zip(*pairs))
                yield from rows(table.take(pa.array(i)), table.take(pa.array(j)), run[i])
            # Rows of the last run may go on; of those before it the ends are known.
            at = np.arange(len(pos))
            ended = np.r_[begins[1:], len(pos) + WINDOW + 1][np.searchsorted(begins, at, "right") - 1]
            # A row is told once, when it is read: as one of the first 50 of its run, or when its run has ended.
            head = (at >= fresh) & (pos - run < WINDOW)
            tail = (pos - run >= WINDOW) & (ended - at <= WINDOW)
            told = np.flatnonzero(head | tail)
            yield from rows(table.take(pa.array(told)), None, run[told])
            keep = max(begins[-1], len(pos) - WINDOW)
            held, held_runs = table.slice(keep), run[keep:]
        if len(held_runs):
            left = np.flatnonzero(held["pos"].to_numpy() - held_runs >= WINDOW)
            yield from rows(held.take(pa.array(left)), None, held_runs[left])

    return find


def _near_refinements(ranked: DataFrame, reading: str) -> DataFrame:
    """``(pos_i, pos_j, kind)`` of ``refinements`` with the texts of both rules."""
    if reading not in ("intent", "literal"):
        raise ValueError(f"reading must be 'intent' or 'literal', not {reading!r}")
    fields = ["pos", "alpha", "beta", "support"]
    rules = ranked.select(*fields)
    types = [f"{c}_{side} {rules.schema[c].dataType.simpleString()}" for side in "ij" for c in fields]
    found = materialize_compact(rules.mapInArrow(_neighbours(reading), ", ".join([*types, "run long"])), "near_rules")
    ends = found.where("pos_j is null")
    first = ends.select(F.expr(f"pos_i div {WINDOW}").alias("_block"), *[f"{c}_i" for c in fields], F.col("run").alias("run_i"))
    second = ends.select(
        F.explode(F.expr(f"array(pos_i div {WINDOW}, pos_i div {WINDOW} - 1)")).alias("_block"),
        *[F.col(f"{c}_i").alias(f"{c}_j") for c in fields],
        F.col("run").alias("run_j"),
    )
    across = first.join(second, "_block").where(f"pos_j - pos_i between 1 and {WINDOW} and run_i <> run_j")
    columns = [f"{c}_{side}" for side in "ij" for c in fields]
    near = (
        "(contains(alpha_j, alpha_i) and contains(beta_j, beta_i)"
        " or contains(alpha_i, alpha_j) and contains(beta_i, beta_j))"
        f" and {_supported('support_i', 'support_j')}"
    )
    forward = refines_sql("alpha_i", "beta_i", "alpha_j", "beta_j", reading)
    backward = refines_sql("alpha_j", "beta_j", "alpha_i", "beta_i", reading)
    kind = F.when(F.expr(forward), "fwd").otherwise("bwd")
    pairs = found.where("pos_j is not null").select(*columns).unionByName(across.select(*columns))
    return pairs.where(f"{near} and ({forward} or {backward})").select(
        "pos_i", "pos_j", kind.alias("kind"), "alpha_i", "beta_i", "alpha_j", "beta_j"
    )


def refinements(ranked: DataFrame, reading: str = "intent") -> DataFrame:
    """``(pos_i, pos_j, kind)`` for rules at most 50 positions apart of which one refines the other.

    ``kind`` is ``fwd`` when the earlier rule refines the later one, else ``bwd``. ``ranked`` is stored in the
    order of positions, so each task compares the neighbours it reads, by lengths and letters first, and no rule
    is shuffled but the first and last 50 of a run. Those are joined on blocks of 50 positions; the later rule is
    placed in its own block and the one before. Rows in any other order are short runs, with the same result.
    """
    return _near_refinements(ranked, reading).select("pos_i", "pos_j", "kind")


def _resolve_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Positions eliminated by the rows of one block.

    A rule that is gone when its turn comes eliminates nothing; one stopped by a later rule has
    already eliminated what stood before that rule.
    """
    stopped = rows.loc[rows["src"] == rows["dst"], "src"]
    gone: set[int] = set()
    edges = rows.loc[rows["src"] != rows["dst"]].sort_values("src")
    for src, dst in zip(edges["src"], edges["dst"]):
        if src not in gone:
            gone.add(dst)
    found = pd.Series(sorted(gone.union(stopped)), dtype="int64")
    return pd.DataFrame({"pos": found[found // ELIMINATION_BLOCK == key[0]]})


def eliminated_positions(pairs: DataFrame, reading: str = "intent") -> DataFrame:
    """Positions of redundant rules, resolved in independent blocks of positions.

    Whether a rule is alive depends on earlier rules through a chain of refinements. Along a
    chain the lengths of alpha and beta only grow (by intent alpha alone) and both are at most
    12, and each step spans at most 50 positions. A block that also sees the rows of that many
    positions before it therefore decides its own rules exactly, and no group exceeds the block.
    """
    steps = MAX_SUBSTRING if reading == "intent" else MAX_SUBSTRING * MAX_SUBSTRING
    halo = steps * WINDOW
    stop = F.min(F.when(F.col("kind") == "bwd", F.col("pos_j"))).over(W.partitionBy("pos_i"))
    effects = pairs.withColumn("_stop", stop).where(
        "(kind = 'fwd' and (_stop is null or pos_j < _stop)) or (kind = 'bwd' and pos_j = _stop)"
    )
    placed = effects.select(
        F.col("pos_i").alias("src"),
        F.expr("if(kind = 'fwd', pos_j, pos_i)").alias("dst"),
    ).withColumn(
        "block",
        F.explode(
            F.expr(
                f"sequence(dst div {ELIMINATION_BLOCK}, (dst + {halo}) div {ELIMINATION_BLOCK})"
            )
        ),
    )
    return placed.groupBy("block").applyInPandas(_resolve_block, "pos long")


def _check_window(window: int) -> None:
    if window != WINDOW:
        raise ValueError(f"window must be {WINDOW} or None, not {window!r}")


def _redundant(ranked: DataFrame, reading: str, window: int | None) -> DataFrame:
    if window is None:
        return eliminated_anywhere(all_refinements(ranked, reading))
    _check_window(window)
    return eliminated_positions(refinements(ranked, reading), reading)


def eliminate_redundant(ranked: DataFrame, reading: str = "intent", window: int | None = WINDOW) -> DataFrame:
    """``(alpha, beta)`` of the rules that survive, sorted by beta then alpha.

    By default rules are compared within 50 positions, as in the original; ``window=None`` compares all.
    """
    if window is None:
        gone = _redundant(ranked, reading, window)
        return ranked.join(gone, "pos", "left_anti").select("alpha", "beta").orderBy("beta", "alpha")
    _check_window(window)
    near = _near_refinements(ranked, reading)
    pairs = materialize_compact(near, "refinements", spent=near)
    gone = eliminated_positions(pairs, reading)
    texts = pairs.select(F.expr("""inline(array(struct(pos_i as pos, alpha_i as alpha, beta_i as beta),
        struct(pos_j as pos, alpha_j as alpha, beta_j as beta)))"""))
    # A rule and the mark that it is gone meet in the ranges that sort the result; there is no other shuffle of rules.
    marked = ranked.select("alpha", "beta", F.lit(True).alias("_rule")).unionByName(
        texts.join(gone, "pos", "left_semi").select("alpha", "beta", F.lit(False).alias("_rule"))
    )
    by_text = ["beta", "alpha"]
    ordered = in_ranges(marked, by_text, range_starts(ranked, by_text)).sortWithinPartitions(*by_text, "_rule")
    return ordered.mapInArrow(_unmarked, "alpha string, beta string")


def _unmarked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(alpha, beta)`` of sorted rules, each once, without those that a row with ``_rule`` false comes before."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = [batch.column(c) for c in ("alpha", "beta")]
        first = np.ones(len(batch), bool)
        for k, text in enumerate(texts):
            same = pc.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
            first[1:] = ~same if k == 0 else first[1:] | ~same
        first[0] = last != tuple(text[0] for text in texts)
        last = tuple(text[len(batch) - 1] for text in texts)
        kept = pa.array(first & batch.column("_rule").to_numpy(zero_copy_only=False))
        yield pa.record_batch(texts, names=["alpha", "beta"]).filter(kept)


def mine_rules(
    size_log: DataFrame,
    scope: str = "full",
    size_percent: int | None = None,
    order: str = "asc",
    reading: str = "intent",
    window: int | None = WINDOW,
) -> DataFrame:
    """The whole miner: size log to final rules."""
    rules = likely_rules(size_log, scope, size_percent)
    return eliminate_redundant(ranked_rules(rules, order), reading, window)


def mine_supported_rules(
    size_log: DataFrame,
    scope: str = "full",
    size_percent: int | None = None,
    order: str = "asc",
    reading: str = "intent",
    min_support: int = 1,
    only: Callable[[DataFrame], DataFrame] = lambda rules: rules,
    window: int | None = WINDOW,
) -> DataFrame:
    """``(pos, alpha, beta, support)`` of the final rules; those with most support have the first ``pos``.

    ``min_support`` and ``only`` select likely rules before redundant ones are eliminated, so that no rule
    is given up for one that is not used.
    """
    likely = only(likely_rules(size_log, scope, size_percent).where(F.col("support") >= min_support))
    ranked = materialize(ranked_rules(likely, order), "ranked_rules")
    gone = _redundant(ranked, reading, window)
    final = ranked.join(gone, "pos", "left_anti")
    return final.select((-F.col("support")).alias("pos"), "alpha", "beta", "support")
