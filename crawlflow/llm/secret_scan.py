"""Secret scans by a trigram inverted index, in DataFrame functions alone.

``trigram_query`` derives from each rule's pattern which trigrams a match must hold: an AND of
clauses, each an OR of alternatives, each an AND of trigrams. The postings (trigram -> texts) of
just those trigrams are built from lower-cased texts, joined to the queries and intersected by
counting; a text is a candidate of a rule if every clause has a complete alternative. Candidates
are verified with the pattern. A rule without a mandatory trigram scans every text.

Matches are leftmost and not overlapping per rule; those that fail a rule's minimum are dropped
after matching. Spans are code points, end exclusive. A null text is empty and has none. Texts are
told apart by ``doc_id`` and content, so repeated rows, rows without id and different texts under
one id each give a row; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from crawlflow.llm.common import whole_texts


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """``pattern`` for Java and RE2; of its ``group`` at least ``least`` characters are asked for."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# A private key: header, RFC 1421 headers, any amount of base64 and line breaks (nothing else, so prose between
# a header and an END line stays), END line; without END the headers and the lines of base64 that follow, up to 240 (RSA of 16,384 bits has 197). Java recurses per repeat of a group and RE2 takes at
# most 1,000 nested repeats, so groups are bounded and single classes are not.
KEY_HEADERS = "(?:[\\r\\n]+[A-Za-z0-9-]{1,40}:\\x20[^\\r\\n]*){0,9}"
KEY_END = f"{KEY_HEADERS}[A-Za-z0-9+/=\\x20\\t\\r\\n\\\\\"',>]*-----END [A-Z ]{{0,30}}PRIVATE KEY-----"
KEY_BREAK = "[\\x20\\t\\r\\n\\\\\"'+,>]"
KEY_LINES = f"(?:{KEY_BREAK}*[A-Za-z0-9+/=]{{16,}})"
KEY_BODY = (
    f"{KEY_HEADERS}{KEY_LINES}{{1,60}}" + f"{KEY_LINES}{{0,60}}" * 3
    + f"(?:{KEY_BREAK}+[A-Za-z0-9+/]{{1,15}}={{0,2}}(?:[\\r\\n\\\\\"']|$))?"
)

# The three base rules, then well-known public token formats.
BASE_RULES = (
    Rule("assign", f"({'|'.join(map(either_case, ('password', 'passwd', 'secret', 'token')))}|{either_case('api')}_?{either_case('key')})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("github", "gh[opsu]_[A-Za-z0-9]{36,255}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}"),
    Rule("private_key", f"-----BEGIN [A-Z ]{{0,30}}PRIVATE KEY-----(?:{KEY_END}|{KEY_BODY})?"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES
#: Letter classes up to this size are spelled out, and so many alternatives kept in a clause.
SMALL_CLASS, MAX_ALTERNATIVES = 8, 64

Clause = frozenset[frozenset[str]]


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[k : k + 3] for k in range(len(text) - 2))


def trigram_query(pattern: str) -> set[Clause]:
    """The clauses of ``pattern``; none if a match need not hold any trigram."""
    clauses: set[Clause] = set()

    def flush(runs: set[str]) -> set[str]:
        clause = frozenset(map(trigrams, runs))
        if all(clause):  # an alternative that asks for more than another one adds nothing
            clauses.add(frozenset(a for a in clause if not any(b < a for b in clause)))
        return {""}

    def spelled(op, value) -> set[str] | None:
        """All texts an element stands for, lower-cased, if they are few."""
        name = str(op)
        if name == "LITERAL":
            return {chr(value).lower()}
        if name == "IN":
            chars = [c for o, v in value for c in ([v] if str(o) == "LITERAL" else range(v[0], v[1] + 1) if str(o) == "RANGE" else range(99))]
            return {chr(c).lower() for c in chars} if len(chars) <= SMALL_CLASS else None
        if name == "BRANCH":
            parts = [sequence(p) for p in value[1]]
            return set().union(*parts) if all(p is not None for p in parts) else None
        if name == "SUBPATTERN":
            return sequence(value[-1])
        if name == "MAX_REPEAT" and value[1] == 1:
            inner = sequence(value[2])
            return inner if value[0] or inner is None else inner | {""}
        return None

    def sequence(parsed) -> set[str] | None:
        runs = {""}
        for op, value in parsed:
            found = spelled(op, value)
            if found is None or len(runs) * len(found) > MAX_ALTERNATIVES:
                return None
            runs = {a + b for a, b in product(runs, found)}
        return runs

    runs = {""}
    for op, value in re._parser.parse(pattern):
        found = spelled(op, value)
        if found is None or len(runs) * len(found) > MAX_ALTERNATIVES:
            runs = flush(runs)
            runs = found or {""}
        else:
            runs = {a + b for a, b in product(runs, found)}
    flush(runs)
    return clauses


def query_terms(rules: tuple[Rule, ...]) -> list[tuple[str, int, int, str, int, int]]:
    """``rule, clause, alternative, trigram``, the alternative's trigrams, the rule's clauses."""
    out = []
    for rule in rules:
        clauses = sorted(trigram_query(rule.pattern), key=lambda c: sorted(map(sorted, c)))
        for c, clause in enumerate(clauses):
            for a, alternative in enumerate(sorted(clause, key=sorted)):
                out += [(rule.kind, c, a, t, len(alternative), len(clauses)) for t in sorted(alternative)]
    return out


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``doc_id, content, rules``: the rules whose trigram query a text satisfies."""
    terms = query_terms(rules)
    asked = sorted({t[3] for t in terms})
    low = F.lower("text")
    held = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in asked]))
    postings = texts.select("doc_id", "content", F.explode(held).alias("trigram"))
    queries = texts.sparkSession.createDataFrame(terms, "rule string, clause int, alternative int, trigram string, need int, clauses int")
    key = ("doc_id", "content", "rule")
    whole = (
        postings.join(F.broadcast(queries), "trigram")  # as many rows as the rules have trigrams
        .groupBy(*key, "clause", "alternative")
        .agg(F.countDistinct("trigram").alias("n"), F.first("need").alias("need"), F.first("clauses").alias("clauses"))
        .where("n = need")
    )
    met = whole.groupBy(*key).agg(F.countDistinct("clause").alias("n"), F.first("clauses").alias("clauses")).where("n = clauses")
    return met.groupBy("doc_id", "content").agg(F.collect_set("rule").alias("rules"))


def rule_spans(rule: Rule, order: int) -> Column:
    """Spans ``(start, rule_no, stop)`` of one rule: pieces between matches and matches, summed up."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    pieces = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    asked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    lengths = F.arrays_zip(
        F.transform(pieces, F.length).alias("skipped"), F.transform(whole, F.length).alias("matched"), F.transform(asked, F.length).alias("asked")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(NO_SPANS).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["skipped"]
        end = begin + F.coalesce(x["matched"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(order).alias("rule"), end.alias("stop"))
        added = F.when(x["matched"].isNotNull() & (x["asked"] >= rule.least), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), added.alias("spans"))

    return F.aggregate(lengths, start, step, lambda state: state["spans"])


NO_SPANS = "array<struct<start:int,rule:int,stop:int>>"


def marked(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``row``, the whole row of ``docs``, ``text`` and ``spans`` of every row."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    texts = rows.select(F.col("row.doc_id").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("content"))
    found = candidates(texts, rules).withColumnsRenamed({"doc_id": "c_id", "content": "c_content"})
    same = F.col("row.doc_id").eqNullSafe(found["c_id"]) & (F.xxhash64(text) == found["c_content"])
    # The candidates, the smaller side, are hashed: texts are dealt out, but not sorted.
    known = rows.join(found.hint("shuffle_hash"), same, "left").select("row", text.alias("text"), "rules")
    scanned = {r.kind for r in rules if not trigram_query(r.pattern)}
    per_rule = [
        rule_spans(r, k)
        if r.kind in scanned
        else F.when(F.array_contains("rules", r.kind), rule_spans(r, k)).otherwise(F.array().cast(NO_SPANS))
        for k, r in enumerate(rules)
    ]
    return known.select("row", "text", F.array_sort(F.concat(*per_rule)).alias("spans"))


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and ``spans`` (start, rule number, stop; by start, then rule) of every row."""
    return marked(whole_texts(docs), rules).select("row.doc_id", "spans")


def digest(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:stop`` of all spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    line = lambda s: F.concat_ws(":", F.element_at(kinds, s["rule"] + 1), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, line), ",")


def without_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``[kind]`` in the place of every secret; ``n_chars``, if present, counts anew.

    Where spans overlap, the first one's mark stands for their union. Texts without a secret, and
    null texts, stay as they are.
    """
    kinds = F.array(*[F.lit(f"[{r.kind}]") for r in rules])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        between = F.when(s["start"] >= state["at"], F.concat(F.substring("text", state["at"] + 1, s["start"] - state["at"]), F.element_at(kinds, s["rule"] + 1)))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), F.concat(state["out"], F.coalesce(between, F.lit(""))).alias("out"))

    cut = F.aggregate("spans", start, step, lambda s: F.concat(s["out"], F.substring("text", s["at"] + 1, F.length("text"))))
    clean = marked(docs, rules).select("row", F.when(F.size("spans") > 0, cut).otherwise(F.col("row.text")).alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return clean.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
