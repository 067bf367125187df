"""License scans by an exact set-similarity join, in DataFrame functions alone.

Templates are the word sets of license notices; blocks are the lines of texts. A block matches a
template of n words if it holds at least a = ceil(threshold * n) of them. The join finds every such
pair: words are put in one global order, rarest in the corpus first; a template's prefix are its
n - a + 1 first words, a block's prefix leaves a - 1 of its template words; a match must share a
word of both prefixes (prefix filter), blocks with fewer than a template words cannot match (length
filter), and the words left after the shared one must suffice (positional filter). Surviving pairs
are verified by intersection. Words of no template are rarest of all for this purpose and drop out
of the prefixes at once.

Base places of phrases are found beside it by consecutive words. A null text is empty. Texts are
told apart by ``doc_id`` and content, so repeated rows, rows without id and different texts under
one id each give a row; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crawlflow.llm.common import whole_texts
from crawlflow.session import materialize

THRESHOLD = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: digits, letters and everything beyond ASCII. Both cases, for texts as they are.
WORD_CHARS = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]"
WORD, GAP = f"{WORD_CHARS}+", "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

# Base phrases and their labels; notices and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "mit-notice": "Released under the terms of the MIT License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def phrase_pattern(phrase: str) -> str:
    """The phrase's words in either case, consecutive and whole."""
    word = lambda w: "".join(f"[{c.upper()}{c}]" for c in w)
    return f"(?<!{WORD_CHARS}){GAP.join(map(word, phrase.split()))}(?!{WORD_CHARS})"


def templates(notices: dict[str, str], threshold: float) -> dict[str, tuple[list[str], int]]:
    """Label to distinct words and the number of them that a block must hold."""
    import re

    sets = {k: list(dict.fromkeys(re.findall(r"[0-9a-z]+", v.lower()))) for k, v in notices.items()}
    return {k: (w, math.ceil(threshold * len(w) - 1e-9)) for k, w in sets.items()}


def blocks(texts: DataFrame, vocabulary: list[str], least: int) -> DataFrame:
    """``doc_id, content, line, words``: the template words of every line that has ``least``."""
    lines = texts.select("doc_id", "content", F.posexplode(F.split("text", "\n", -1)).alias("line", "block"))
    known = F.array(*map(F.lit, vocabulary))
    words = F.array_intersect(F.regexp_extract_all(F.translate("block", UPPER, LOWER), F.lit(WORD), F.lit(0)), known)
    return lines.select("doc_id", "content", "line", words.alias("words")).where(F.size("words") >= least)


def matches(texts: DataFrame, notices: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, content, line, label, containment`` of every block and template at or above."""
    sets = templates(notices, threshold)
    vocabulary = sorted({w for words, _ in sets.values() for w in words})
    found = materialize(blocks(texts, vocabulary, min(a for _, a in sets.values())), "blocks")
    # One row per template word at most.
    counts = dict(found.select(F.explode("words").alias("w")).groupBy("w").count().collect())
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    prefixes = []
    for label, (words, least) in sets.items():
        ordered = sorted(words, key=rank.__getitem__)
        prefixes += [(w, label, i, len(words), least, words) for i, w in enumerate(ordered[: len(words) - least + 1])]
    prefix = texts.sparkSession.createDataFrame(prefixes, "word string, label string, i int, n int, least int, template array<string>")
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    ordered = F.transform(F.array_sort(F.transform("words", lambda w: F.struct(F.element_at(ranks, w).alias("r"), w.alias("w")))), lambda s: s["w"])
    sorted_blocks = found.select("doc_id", "content", "line", F.size("words").alias("m"), ordered.alias("words"))
    probing = sorted_blocks.select("*", F.posexplode("words").alias("j", "word"))
    pairs = probing.join(F.broadcast(prefix), "word").where(  # a row per template word at most
        (F.col("m") >= F.col("least"))
        & (F.col("j") <= F.col("m") - F.col("least"))
        & (1 + F.least(F.col("n") - 1 - F.col("i"), F.col("m") - 1 - F.col("j")) >= F.col("least"))
    )
    shared = F.size(F.array_intersect("words", "template"))
    verified = pairs.withColumn("shared", shared).where("shared >= least")
    return verified.select("doc_id", "content", "line", "label", (F.col("shared") / F.col("n")).alias("containment")).distinct()


def base_places(text: Column) -> dict[str, Column]:
    """Number, first and last word of the phrases' places, and their labels."""
    count = {p: F.regexp_count(text, F.lit(phrase_pattern(p))) for p in PHRASES}
    any_phrase = "|".join(map(phrase_pattern, PHRASES))
    words_before = lambda pattern: F.regexp_count(F.regexp_extract(text, pattern, 1), F.lit(WORD)).cast("long")
    total = reduce(lambda a, b: a + b, count.values()).cast("long")
    labels = F.array_compact(F.array(*[F.when(count[p] > 0, F.lit(label)) for p, label in PHRASES.items()]))
    return {
        "n_base": total,
        "first_word": F.when(total > 0, words_before(f"(?s)^(.*?)(?:{any_phrase})")),
        "last_word": F.when(total > 0, words_before(f"(?s)^(.*)(?:{any_phrase})")),
        "base": labels,
    }


def license_scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row."""
    texts = whole_texts(docs).withColumn("content", F.xxhash64("text"))
    found = matches(texts).groupBy("doc_id", "content").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    found = found.withColumnsRenamed({"doc_id": "m_id", "content": "m_content"})
    # Few texts say "license" at all; only those are searched for phrases.
    worded = F.lower("text").contains("license")
    none = {"n_base": F.lit(0).cast("long"), "first_word": F.lit(None).cast("long"), "last_word": F.lit(None).cast("long"), "base": F.array().cast("array<string>")}
    places = {k: F.when(worded, v).otherwise(none[k]).alias(k) for k, v in base_places(F.col("text")).items()}
    own = texts.select("doc_id", "content", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), *places.values())
    both = own.join(found, own["doc_id"].eqNullSafe(found["m_id"]) & (own["content"] == found["m_content"]), "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", more)).alias("labels"), F.coalesce("best", F.lit(0.0)).alias("score"),
    )
