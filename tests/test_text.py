import html
import random
import re

import pytest
from pyspark.sql import functions as F

from crawlflow import session
from crawlflow.functions import html as H, text as X
from crawlflow.functions.stem import english, porter
from crawlflow.operators import crawl

# Published examples of both algorithms.
PORTER = """
caresses caress ponies poni ties ti cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan
falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat
conditional condit rational ration valenci valenc digitizer digit operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electrical electr
hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt communism commun activate activ angulariti angular
homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas
controll control roll roll be be
"""
ENGLISH = """
consign consign consigned consign consistency consist consistently consist consolatory consolatori
consolingly consol conspicuously conspicu knack knack knackeries knackeri knaves knave
knavish knavish knightly knight knots knot kneaded knead generate generat generously generous
communication communic skies sky dying die happily happili only onli using use fluently fluentli
cry cri by by say say agreed agre hopping hop hoped hope youth youth boyish boyish kindness kind
gas gas this this kiwis kiwi ties tie cries cri flies fli proceed proceed succeeded succeed
national nation rational ration analogies analog beauty beauti argument argument relativity relat
sensational sensat controlled control
"""


def pairs(text):
    words = text.split()
    return list(zip(words[::2], words[1::2]))


@pytest.mark.parametrize("word,stem", pairs(PORTER))
def test_porter(word, stem):
    assert porter(word) == stem


@pytest.mark.parametrize("word,stem", pairs(ENGLISH))
def test_english(word, stem):
    assert english(word) == stem


def test_tokens(spark):
    text = "The Dog's owner isn't AT U.S.A. or l’été; x_1, 3.14 - the END"
    row = spark.createDataFrame([(text,), ("",), (None,)], "t string")
    got = [r[0] for r in row.select(X.tokens(F.col("t"))).collect()]
    assert got == [["dog", "owner", "isn't", "u.s.a", "l’été", "x_1", "3.14", "end"], [], None]


def test_stems_keep_rows(spark):
    frame = spark.createDataFrame(
        [(1, ["running", "ponies"]), (2, []), (3, None), (4, ["ponies"])], "i int, k array<string>"
    ).repartition(1)
    got = {r.i: r.s for r in frame.select("i", X.stems(F.col("k")).alias("s")).collect()}
    assert got == {1: ["run", "poni"], 2: [], 3: None, 4: ["poni"]}


PAGE = """
<html><head><title>not text</title><script>var t = "</p><a href='no'>";</script></head><body>
<nav><ul><li><A HREF="/a">/Home page/</A ></li><li><a href="/b">All <B class=x>news</B> of today</a></li></ul></nav>
<!-- <p>hidden</p> -->
<p>{long}</p><div>Read <b>more</b> &amp; more<br>{long}</div>
<footer>&copy; small print</footer></body></html>
""".replace("{long}", " ".join(f"word{i}" for i in range(45)))


def test_article(spark):
    row = (
        spark.createDataFrame([(PAGE,)], "html string")
        .transform(H.with_article)
        .select("blocks", H.article_text().alias("text"), *H.article_statistics())
        .first()
    )
    assert [(b.words, b.linked) for b in row.blocks] == [(2, 2), (4, 4), (45, 0), (3, 0), (45, 0), (2, 0)]
    long = " ".join(f"word{i}" for i in range(45))
    assert row.text == f"{long}\nRead more & more\n{long}\n© small print"
    assert (row.words_before, row.words_after, row.avg_block_words) == (101, 95, 95 / 4)
    assert row.low_quality is True


def test_words_are_pieces_with_a_letter_or_digit(spark):
    cases = {"a -- b 3 %%% $x é.": 5, "--": 0, "- -": 0, "x": 1, "": 0, "-- a": 1, "a --": 1}
    frame = spark.createDataFrame([(c,) for c in cases], "t string")
    got = frame.select("t", H._count_words(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in got} == cases


def test_out_links(spark):
    html = """<head><base href="/b/"></head><body><a href="c?d=1&amp;e=2">k</a>
        <a class=x href='//o.com'>z</a><img src=p.png><a href="javascript:x">n</a>
        <!-- <a href="no"> --><a href="#q">s</a><a href="p.png">again</a><a name="none">
        <meta http-equiv="refresh" content="0; url=http://r.s/t"><abbr href="no">
        <a href="mailto:a@b">m</a><a href="">e</a><a href="?z=1">q</a></body>"""
    row = spark.createDataFrame([("http://w.x/y/z.html", html)], "url string, html string")
    assert H.with_out_links(row).first().links == [
        "http://w.x/b/c?d=1&e=2", "http://o.com/", "http://w.x/b/p.png", "http://w.x/b/",
        "http://w.x/b/?z=1", "http://r.s/t",
    ]


def test_character_references(spark):
    cases = [
        "plain & text", "a &amp;lt; b", "&lt;p&gt; &copy; &#39;x&#39;", "caf&eacute; &mdash; &hellip;", "&#8212;&#x2014;&#X1F600;",
        "&#146;&#128;", "&unknown; &#; &", "&NotEqualTilde;&eacute", "&eacute;;&amp;eacute;", "&#xD800;&#9999999;", "", "&#0;",
    ]
    frame = spark.createDataFrame([(i, c) for i, c in enumerate([*cases, "a&#1;b&#9;c"])], "i int, t string")
    got = {r.i: r.t for r in frame.select("i", H._decode(F.col("t")).alias("t")).collect()}
    # A reference without its semicolon stays as it is.
    expected = [c if c.startswith("&NotEqual") else html.unescape(c) for c in cases]
    expected[7] = "≂̸&eacute"
    assert [got[i] for i in range(len(cases))] == expected
    assert got[len(cases)] == "ab c"


def plain_sentences(blocks):
    """Main text by walking over the blocks, one merge after another."""
    density = lambda b: b.linked / b.words if b.words else 0.0
    pieces = []
    for i, b in enumerate(blocks):
        before, after = (blocks[i - 1] if i else None), (blocks[i + 1] if i + 1 < len(blocks) else None)
        next_words = after.words if after else 0
        if before is None or density(before) <= 0.555556:
            good = not (b.words <= 16 and next_words <= 15 and (before.words if before else 0) <= 4)
        else:
            good = not (b.words <= 40 and next_words <= 17)
        good = good and density(b) <= 0.333333
        if good and pieces:
            pieces[-1] = (True, pieces[-1][1], i, [*pieces[-1][3], b])
        else:
            pieces.append((good, i, i, [b]))
    joined = []
    for _, first, last, members in (p for p in pieces if p[0]):
        if joined and first - joined[-1][0] - 1 <= 1:
            joined[-1] = (last, joined[-1][1] + members)
        else:
            joined.append((last, members))
    best = max(joined, key=lambda p: sum(b.words for b in p[1]), default=(0, []))[1]
    return [b.text for b in best if any(
        len(c.split()) >= 5 for c in re.split(r"(?<=[^\W_])[,.:;!?]+(?: +|$)", b.text)[:-1])]


def test_sentences_against_walk(spark):
    rng = random.Random(5)

    def block():
        words = " ".join(rng.choice(["news", "of", "the day,", "said.", "x"]) for _ in range(rng.choice([1, 3, 6, 18, 30])))
        return f"<p>{words}</p>" if rng.random() < 0.7 else f"<p><a href='/x'>{words}</a></p>"

    pages = [(i, "<html><body>" + "".join(block() for _ in range(rng.randint(0, 14))) + "</body></html>") for i in range(150)]
    pages += [(900, ""), (901, None), (902, "<html><body><p>one two three four five.</p></body></html>")]
    got = spark.createDataFrame(pages, "i int, html string").transform(H.with_sentences).select("i", "blocks", "article").collect()
    assert len(got) == len(pages)
    found = 0
    for row in got:
        if row.blocks is None:
            assert row.i == 901 and not row.article
            continue
        assert [b.text for b in row.article] == plain_sentences(row.blocks)
        found += 0 < len(row.article) < len(row.blocks)
    assert found > 50


def test_stemmer_gets_small_batches(spark):
    """Tokens go to Python workers in batches of bounded bytes, not of ten thousand pages, unless the session has a bound."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting, None)
    page = "<html><body><p>" + "Running dogs jumped over the lazy foxes again and again today. " * 20 + "</p></body></html>"
    crawled = spark.createDataFrame([(f"http://a/{k}", page) for k in range(300)], "url string, html string").selectExpr(
        "url", "timestamp_millis(0) as date", "html"
    )
    try:
        spark.conf.unset(setting)
        whole = {(r.url, tuple(r.tokens)) for r in crawl.article_tokens(crawled).collect()}
        assert int(spark.conf.get(setting)) == session.BATCH_BYTES
        spark.conf.set(setting, "3000")
        cut = {(r.url, tuple(r.tokens)) for r in crawl.article_tokens(crawled).collect()}
        assert spark.conf.get(setting) == "3000"
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    assert cut == whole and len(whole) == 300
