import random
import re
from collections import Counter

import numpy as np

from crawlflow.llm import quality_rules as Q, toxicity as X
from crawlflow.llm.common import table

SF = "/root/testdata/sf0.1"


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_counts_match_brute_force(spark):
    rng = random.Random(2)
    texts = ["", "a", " \n\t\n", "é\x0b日 x\x0cy", "# *|<> a", "a b c d e f g h " * 3, "a " * 9, "a " * 8, "x\nx\n x\nx", "w " * 60_000]
    texts += [" ".join(rng.choices("abc", k=rng.randrange(60))) + rng.choice("\n\r") + "".join(rng.choices("a \n# ", k=30)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, None, 1)], "doc_id long, text string, n_words int")
    got = {r.doc_id: tuple(r[c] for c in Q.COUNTS) for r in Q.statistics(docs).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(texts)} | {None: (0,) * 5}


def test_cover_learns_a_conjunction():
    rng = np.random.default_rng(0)
    x, y = rng.random(3000), rng.random(3000)
    low = (x > 0.7) & (y <= 0.4)
    rules = Q.cover({"x": x, "y": y}, low, np.arange(3000) % 3 == 0)
    hit = np.any([Q.covered(r, {"x": x, "y": y}, 3000) for r in rules], axis=0)
    assert np.mean(hit == low) > 0.97 and rules[0][0].feature in "xy"


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rules = Q.learn(docs, labels.where("doc_id % 5 > 0"))
    rows = Q.apply_rules(docs, rules).join(labels.where("doc_id % 5 = 0"), "doc_id").select("good", "quality").collect()
    assert np.mean([r.good == bool(r.quality) for r in rows]) > 0.97


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, "x")], "doc_id long, text string, quality string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.good for r in Q.apply_rules(docs, Q.learn(docs, none)).collect()] == [True] * 3
    assert Q.apply_rules(docs.where("false"), []).collect() == []


def test_fold():
    assert X.fold("L0ser, 1DIOT!") == " ioser  idiot  " and X.fold("іdіоt") == X.fold("idiot") and X.fold("s​cum") == " scum "


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    lexicon = X.learn(docs, labels)
    rows = X.toxicity(docs, lexicon).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    right = sum(r.predicted and r.toxic for r in rows)
    assert 2 * right / (sum(r.predicted for r in rows) + sum(r.toxic for r in rows)) > 0.85
    assert lexicon.score("you " * 40 + "1di0t " * 4) >= 0.3 > lexicon.score("you " * 40)


def test_exceptions_and_edges(spark):
    lexicon = X.Lexicon({" trash ": 5.0, " idio": 6.0}, frozenset({"trash can"}), 1.0)
    assert lexicon.mass("the trash can") == 0 < lexicon.mass("trash cans") and lexicon.mass("trashy") == 0 < lexicon.mass("idiotic")
    assert lexicon.mass("trash " * 3) > lexicon.mass("trash " + "word " * 5000) > 0
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (2, "trash", "x"), (None, "a" * 400_000, "x")], "doc_id long, text string, score string")
    assert sorted(r.predicted for r in X.toxicity(docs, lexicon).collect()) == [0, 0, 0, 1]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.learn(docs, none).weights == {} and X.toxicity(docs.where("false"), lexicon).collect() == []
    assert {r.score for r in X.toxicity(docs, X.Lexicon({})).collect()} == {0.0}
