"""HTML functions as column expressions: out-links, text blocks and article text."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from crawlflow.functions.url import canonical_urls, link_base, resolve_link

# Every tag pattern starts with the literal "<", so that text between tags is passed over fast.
UNSEEN = (
    r"(?is)<(?:!--.*?-->|script\b[^>]*>.*?</script\s*>|style\b[^>]*>.*?</style\s*>)"
)
HEAD = r"(?is)<(?:head\b[^>]*>.*?</head\s*>|/body\s*>.*)"
LINK_TAGS = r"(?i)<(?:a|area|link|img|iframe|frame|embed|base|meta)\s[^>]*>"
BASE_TAG = r"(?i)^<base\s"
REFRESH_TAG = r"(?i)^<meta\s(?:[^>]*\s)?http-equiv\s*=\s*[\"']?refresh"
NO_LINK_TAG = r"(?i)^<(?:base|meta)\s"
REFRESH_TARGET = r"(?i)url\s*=\s*([^\"'\s>;]+)"
TARGET = r"(?i)\s(?:href|src)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
SKIPPED_LINK = r"(?i)javascript:|mailto:|@"

# Marks put in place of tags; control characters do not occur in page text. Inline tags, anchors
# among them, leave their name between two marks; all others end a block.
MARK, BREAK = "\u0001", "\u0003"
INLINE_TAG = (
    r"(?i)<(/?)(a|strike|u|b|i|em|strong|span|sup|sub|code|tt|var|abbr|acronym|font)(?:\s[^>]*)?>"
)
INLINE_MARK = "(?i)\u0001/?(?!a\u0002)[a-z]+\u0002"
ANCHOR_MARK = "(?i)\u0001/?a\u0002"
LINKED_TEXT = "(?i)\u0001a\u0002([^\u0001]*)\u0001/a\u0002"
ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
)
# Any reference that ends in a semicolon, and one that ENTITIES does not hold.
REFERENCE = "&(?=(?:#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]*);)"
OTHER_REFERENCE = REFERENCE + "(?!(?:" + "|".join(entity[1:] for entity, _ in ENTITIES) + "))"
# Blanks that are not already one single space.
LOOSE_BLANKS = r"[ \t\r\n\f\x{A0}]{2,}|[\t\r\n\f\x{A0}]"
# A piece between spaces without any letter or digit, which does not count as a word.
NO_WORD = r"[^\p{L}\p{N} ](?<![^ ].)[^\p{L}\p{N} ]*+(?![^ ])"

# Thresholds of the published word-count and link-density tree.
MAX_LINK_DENSITY = 0.333333
MAX_PREVIOUS_DENSITY = 0.555556

# Where a clause ends, and the fewest words of one; fixed values of the published clause filter.
CLAUSE_END = r"([\p{L}0-9][,.:;!?]+)(?:[ \n\r]+|$)"
MIN_CLAUSE_WORDS = 5

# Fixed value: pieces of an article with at most one block between them are one.
MAX_FUSED_GAP = 1

# Below any of these an article counts as low quality.
MIN_WORDS_BEFORE, MIN_WORDS_AFTER, MIN_BLOCK_WORDS = 90, 70, 25


def is_html(html: Column) -> Column:
    return html.rlike("(?i)<html|<!doctype html")


def _tag_target(tag: Column) -> Column:
    raw = F.regexp_extract(tag, TARGET, 1)
    return F.replace(F.trim(F.regexp_replace(raw, "[\"']", "")), F.lit("&amp;"), F.lit("&"))


def with_out_links(df: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Add ``links``, the distinct canonical links of a page; an array, so nothing is shuffled."""
    return (
        with_resolved_links(df, html, url)
        .withColumn("links", F.array_distinct(F.array_compact(canonical_urls(F.col("resolved")))))
        .drop("resolved")
    )


def with_resolved_links(df: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Add ``resolved``, the links of a page, each spelling once, as absolute URLs.

    One pass takes out the comments and scripts, one finds the tags; the rest works on tags.
    """
    tags = F.regexp_extract_all(F.regexp_replace(html, UNSEEN, " "), F.lit(LINK_TAGS), F.lit(0))
    refresh = F.transform(
        F.filter("_tags", lambda tag: tag.rlike(REFRESH_TAG)),
        lambda tag: F.regexp_extract(tag, REFRESH_TARGET, 1),
    )
    targets = F.transform(F.filter("_tags", lambda tag: ~tag.rlike(NO_LINK_TAG)), _tag_target)
    stated = _tag_target(F.get(F.filter("_tags", lambda tag: tag.rlike(BASE_TAG)), F.lit(0)))
    resolved = F.transform("_targets", lambda t: resolve_link(t, F.col("_base")))
    return (
        df.withColumn("_tags", tags)
        .withColumn("_stated", F.coalesce(stated, F.lit("")))
        .withColumn(
            "_targets",
            F.array_distinct(
                F.filter(
                    F.concat(targets, refresh), lambda t: (t != "") & ~t.rlike(SKIPPED_LINK)
                )
            ),
        )
        .withColumn("_page", link_base(F.col(url)))
        .withColumn(
            "_base",
            F.when(F.col("_stated") == "", F.col("_page")).otherwise(
                link_base(resolve_link(F.col("_stated"), F.col("_page")))
            ),
        )
        .withColumn("resolved", resolved)
        .drop("_tags", "_stated", "_targets", "_page", "_base")
    )


def _collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, LOOSE_BLANKS, " "))


def _code_point(code: Column) -> Column:
    """The character of a numeric reference: bytes of Windows-1252 as browsers read them, no control characters."""
    windows = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd")
        .when(code.isin(9, 10, 12, 13), " ")
        .when((code < 32) | (code == 127), "")
        .when(code.between(128, 159), F.substring(F.lit(windows), code.cast("int") - 127, F.lit(1)))
        .otherwise(plain)
    )


def _reference(piece: Column) -> Column:
    """A text that starts behind the ``&`` of a reference, with its character; unknown names stay."""
    body = F.substring_index(piece, ";", 1)
    # One string, as a map of that many literals makes plans slow.
    names = F.lit("".join(f"\u0004{name}\u0005{char}" for name, char in html5.items() if name.endswith(";")) + "\u0004")
    entry = F.concat(F.lit("\u0004"), body, F.lit(";\u0005"))
    named = F.when(
        F.contains(names, entry), F.substring_index(F.call_function("substring_index", names, entry, F.lit(-1)), "\u0004", 1)
    )
    rest = F.substring(piece, F.length(body) + 2, F.length(piece))
    number = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, F.lit(3), F.length(body)), 16, 10)).when(
        body.startswith("#"), F.substring(body, F.lit(2), F.length(body))
    )
    char = F.when(body.startswith("#"), _code_point(number.cast("long"))).otherwise(named)
    return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))


def _decode(text: Column) -> Column:
    """Character references as characters, none decoded twice: the frequent ones by plain replacement,
    ``&amp;`` last; texts with any other piece by piece."""

    def frequent(t: Column) -> Column:
        for entity, char in ENTITIES:
            t = F.replace(t, F.lit(entity), F.lit(char))
        return t

    def every(t: Column) -> Column:
        pieces = F.split(t, REFERENCE)
        following = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), _reference)
        return F.concat(pieces[0], F.array_join(following, ""))

    # Bound as an array's element, so that the text is computed once.
    return F.transform(F.array(text), lambda t: F.when(t.rlike(OTHER_REFERENCE), every(t)).otherwise(frequent(t)))[0]


def _count_words(text: Column) -> Column:
    """Words of a plain text: pieces between spaces that hold a letter or digit."""
    pieces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    other = F.size(F.regexp_extract_all(text, F.lit(NO_WORD), F.lit(0)))
    return F.when(text == "", 0).otherwise(pieces - other)


def marked_body(html: Column) -> Column:
    """The text of the page body with single blanks, inline tags and block ends marked."""
    body = F.regexp_replace(F.regexp_replace(html, UNSEEN, " "), HEAD, "")
    body = F.regexp_replace(body, INLINE_TAG, "\u0001$1$2\u0002")
    body = F.regexp_replace(body, "<[^>]*>", BREAK)
    return _collapse(_decode(body))


def _block_texts(raw: Column) -> Column:
    """``struct(text, anchors)`` of one marked block."""
    anchored = F.regexp_replace(raw, INLINE_MARK, "")
    linked = F.regexp_extract_all(anchored, F.lit(LINKED_TEXT), F.lit(1))
    marked = raw.contains(MARK)
    bare = _collapse(F.regexp_replace(anchored, ANCHOR_MARK, ""))
    return F.struct(
        F.when(marked, bare).otherwise(F.trim(raw)).alias("text"),
        F.when(marked, _collapse(F.array_join(linked, " "))).otherwise("").alias("anchors"),
    )


def _block(texts: Column) -> Column:
    """``struct(text, words, linked)`` of one block."""
    return F.struct(
        texts["text"].alias("text"),
        _count_words(texts["text"]).alias("words"),
        F.when(texts["anchors"] == "", 0)
        .otherwise(_count_words(texts["anchors"]))
        .alias("linked"),
    )


def with_blocks(df: DataFrame, html: str = "html", name: str = "blocks") -> DataFrame:
    """Add the text blocks of a page in order; blocks without any text are left out."""
    texts = F.transform(F.split(marked_body(F.col(html)), BREAK), _block_texts)
    return df.withColumn(name, F.transform(F.filter(texts, lambda b: b["text"] != ""), _block))


def _density(block: Column) -> Column:
    return F.when(block["words"] > 0, block["linked"] / block["words"]).otherwise(F.lit(0.0))


def _content_rule(blocks: Column):
    """Whether a block is article text, judged by its own and its neighbours' statistics."""

    def is_content(block: Column, i: Column) -> Column:
        previous, following = F.get(blocks, i - 1), F.get(blocks, i + 1)
        previous_words = F.coalesce(previous["words"], F.lit(0))
        following_words = F.coalesce(following["words"], F.lit(0))
        after_text = ~(
            (block["words"] <= 16) & (following_words <= 15) & (previous_words <= 4)
        )
        after_links = ~((block["words"] <= 40) & (following_words <= 17))
        return (_density(block) <= MAX_LINK_DENSITY) & F.when(
            F.coalesce(_density(previous), F.lit(0.0)) <= MAX_PREVIOUS_DENSITY, after_text
        ).otherwise(after_links)

    return is_content


def content_blocks(blocks: Column) -> Column:
    return F.filter(blocks, _content_rule(blocks))


def _has_clause(block: Column) -> Column:
    """Whether one of the text's delimited clauses has at least five words; what follows the last end is none."""
    pieces = F.split(F.regexp_replace(block["text"], CLAUSE_END, f"$1{MARK}"), MARK)
    ended = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.exists(ended, lambda c: F.size(F.split(c, "[ \n\r]+")) >= MIN_CLAUSE_WORDS)


def with_sentences(df: DataFrame, html: str = "html") -> DataFrame:
    """Add ``blocks`` and ``article``: the paragraphs of the page's main text that hold a clause.

    Content blocks, and the one block before a run of them (mostly its heading), are one piece; pieces with at
    most one block between them are joined; the piece with most words stays, the first of equal ones. Of its
    paragraphs those with a delimited clause of five or more words are the article. Pieces are kept as the
    positions where they begin and end, so a page costs its number of blocks.
    """
    blocks, content = F.col("blocks"), F.col("_content")
    is_content = _content_rule(blocks)
    begins = F.filter(
        F.transform(content, lambda c, i: F.when((i == 0) | ~c, i)), lambda i: i.isNotNull()
    )

    def piece(begin: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("_begins"), k + 1), F.size("blocks")) - 1
        return F.when(
            (end > begin) | F.get(content, begin), F.struct(begin.alias("begin"), end.alias("end"))
        )

    pieces = F.filter(F.transform("_begins", piece), lambda p: p.isNotNull())
    apart = F.filter(
        F.transform(
            "_pieces",
            lambda p, k: F.when(
                (k == 0) | (p["begin"] - F.get(F.col("_pieces"), k - 1)["end"] - 1 > MAX_FUSED_GAP), k
            ),
        ),
        lambda k: k.isNotNull(),
    )

    def fused(first: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(F.col("_apart"), k + 1), F.size("_pieces"))
        members = F.slice("_pieces", first + 1, stop - first)
        paragraphs = F.flatten(
            F.transform(members, lambda p: F.slice(blocks, p["begin"] + 1, p["end"] - p["begin"] + 1))
        )
        return F.struct(F.aggregate(paragraphs, F.lit(0), lambda n, b: n + b["words"]).alias("words"), (-k).alias("order"), paragraphs.alias("paragraphs"))

    largest = F.coalesce(F.array_max("_fused")["paragraphs"], F.slice(blocks, 1, 0))
    return (
        with_blocks(df, html)
        .withColumn("_content", F.transform(blocks, is_content))
        .withColumn("_begins", begins)
        .withColumn("_pieces", pieces)
        .withColumn("_apart", apart)
        .withColumn("_fused", F.transform("_apart", fused))
        .withColumn("article", F.filter(largest, _has_clause))
        .drop("_content", "_begins", "_pieces", "_apart", "_fused")
    )


def with_article(df: DataFrame, html: str = "html") -> DataFrame:
    """Add ``blocks`` and ``article``, the blocks of the page and those that are content."""
    return with_blocks(df, html).withColumn("article", content_blocks(F.col("blocks")))


def article_text() -> Column:
    return F.array_join(F.transform("article", lambda b: b["text"]), "\n")


def _words(blocks: str) -> Column:
    return F.aggregate(blocks, F.lit(0), lambda n, b: n + b["words"])


def article_statistics() -> list[Column]:
    """Word statistics before and after extraction, with a low-quality flag that drops nothing."""
    before, after = _words("blocks"), _words("article")
    average = F.when(F.size("article") > 0, after / F.size("article")).otherwise(F.lit(0.0))
    low = (before < MIN_WORDS_BEFORE) | (after < MIN_WORDS_AFTER) | (average < MIN_BLOCK_WORDS)
    return [
        before.alias("words_before"),
        after.alias("words_after"),
        average.alias("avg_block_words"),
        low.alias("low_quality"),
    ]
