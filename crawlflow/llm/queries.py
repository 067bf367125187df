"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlflow.llm import (
    byte_pairs, decontamination, fill_middle, language_id, license_scan, prefix_trie, quality_rules, repeats, secret_scan, sentence_pieces, simhash, token_counts, toxicity,
)
from crawlflow.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark, sf_dir):
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > token_counts.TOKEN_LIMIT)


@query
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(language_id.train_rows(docs)))


@query
def op8_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.apply_rules(docs, rules)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc_id", *quality_rules.COUNTS, failed.alias("base_failed"), (~failed & F.col("good")).alias("kept")
    )


@query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query
def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op6_license_scan(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query
def op7_secret_scan(spark, sf_dir):
    found = secret_scan.secret_spans(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE_RULES]
    n_of = lambda k: F.size(F.filter("spans", lambda s: s["rule"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["rule"] < len(kinds))
    return found.select(
        "doc_id", *[n_of(k).alias(f"n_{kind}") for k, kind in enumerate(kinds)],
        F.sha2(secret_scan.digest(base), 256).alias("base_sha256"), secret_scan.digest(F.col("spans")).alias("spans"),
    )


def _ascii_lower(text: str) -> str:
    return f"translate({text}, '{license_scan.UPPER}', '{license_scan.LOWER}')"


def _license_sql() -> str:
    """Brute force: every line against every template, words by position."""
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    at = lambda k: f"list_extract(w, i + {k})"
    tests = {p: " AND ".join(f"{at(k)} = '{x}'" for k, x in enumerate(p.split())) for p in license_scan.PHRASES}
    base = ", ".join(f"[CASE WHEN {t} THEN '{license_scan.PHRASES[p]}' END]" for p, t in tests.items())
    values = ", ".join(
        f"('{k}', [{', '.join(repr(x) for x in words)}], {least})"
        for k, (words, least) in license_scan.templates(license_scan.TEMPLATES, license_scan.THRESHOLD).items()
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all({_ascii_lower('t')}, '{word}') AS w FROM d),
p AS (SELECT r, i, list_filter(flatten([{base}]), lambda x: x IS NOT NULL) AS l
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
b AS (SELECT r, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, flatten(list(l)) AS base
      FROM p WHERE len(l) > 0 GROUP BY r),
lines AS (SELECT r, regexp_extract_all({_ascii_lower('l')}, '{word}') AS lw
          FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM w)),
tpl(label, tw, least) AS (VALUES {values}),
m AS (SELECT r, list(DISTINCT label) AS more, max(len(list_intersect(lw, tw)) / len(tw)) AS best
      FROM lines, tpl WHERE len(list_intersect(lw, tw)) >= least GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(list_distinct(base)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ','), '') AS labels,
       coalesce(best, 0.0) AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN m USING (r)"""


def _secret_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for k, rule in enumerate(secret_scan.RULES):
        m = f"regexp_extract_all(t, {quoted(rule.pattern)}, 0)"
        g = f"regexp_extract_all(t, {quoted(rule.pattern)}, {rule.group})"
        parts.append(f"""
SELECT r, {k} AS rule, '{rule.kind}' AS kind, a AS start, a + len(m[i]) AS stop
FROM (SELECT r, m, g, i, list_sum(list_transform(p[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0) AS a
      FROM (SELECT r, m, g, p, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT r, {m} AS m, {g} AS g, string_split_regex(t, {quoted(rule.pattern)}) AS p FROM d)))
WHERE len(g[i]) >= {rule.least}""")
    line = "kind || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR)"
    joined = f"string_agg({line}, ',' ORDER BY start, rule)"
    kinds = [r.kind for r in secret_scan.BASE_RULES]
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in kinds)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(parts)})
SELECT doc_id, {counts}, sha256(coalesce({joined} FILTER (rule < {len(kinds)}), '')) AS base_sha256,
       coalesce({joined} FILTER (kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id"""


ORACLE |= {"op6_license_scan": _license_sql(), "op7_secret_scan": _secret_sql()}


@query
def op3_sentence_pieces(spark, sf_dir):
    """Ids by digest, and the text that decoding gives back by digest."""
    back = sentence_pieces.decode(sentence_pieces.encode(table(spark, sf_dir, "documents")))
    return back.select("doc_id", "n_pieces", "score", "ids_sha256", F.sha2("text", 256).alias("text_sha256"))


@query
def op2_decontamination(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_suffix_dedup(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op11_fill_middle(spark, sf_dir):
    made = fill_middle.fill_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(), 256).alias("restored_sha256"),
    )


ORACLE["op11_fill_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT *, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2,
             CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS m,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
x AS (SELECT *, substr(t, 1, p) AS a, substr(t, p + 1, m - p) AS b, substr(t, m + 1) AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN m - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b
              ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM x"""


@query
def op13_byte_pairs(spark, sf_dir):
    encoded = byte_pairs.encode(table(spark, sf_dir, "documents"))
    digest = F.sha2(byte_pairs.ids_text("ids"), 256).alias("ids_sha256")
    back = byte_pairs.decode(encoded.select("doc_id", "n_tokens", digest, "ids"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(prefix_trie.rebuilt_paths(table(spark, sf_dir, "conversations")))


# Brute force: every beginning of every conversation as a list, every node once for each of its ancestors.
ORACLE["op12_prefix_trie"] = """
WITH tab AS (SELECT list(v ORDER BY i) AS tab FROM (
       SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
                             lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS v FROM range(256) AS r(i))),
own AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS a
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                lambda x, y: xor(x // 256, tab[(xor(x, y) & 255) + 1])), 4294967295) % 9 AS h FROM own, tab),
p AS (SELECT o.c, list_concat(coalesce(b.a[1:h], []), o.a[h + 1:]) AS p FROM own o JOIN h USING (c) LEFT JOIN own b ON b.c = o.c - o.c % 5),
m AS (SELECT c, p[1:d] AS q, d, d = len(p) AS ends FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM p)),
n AS (SELECT q, d, min(c) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY q, d),
k AS (SELECT q[1:d - 1] AS q, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.d > 0 THEN (n_convs - 1) * strlen(n.q[n.d].t) ELSE 0 END AS gain
      FROM n LEFT JOIN k USING (q, d)),
s AS (SELECT q[1:u] AS q, u AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum(gain) AS saved
      FROM (SELECT q, gain, n_children, unnest(range(0, d + 1)) AS u FROM f) GROUP BY 1, 2)
SELECT f.conv_id, f.d AS depth, o.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (q, d) LEFT JOIN n o ON o.d = f.d - 1 AND o.q = f.q[1:f.d - 1]"""
