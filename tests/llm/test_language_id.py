import numpy as np
import pyarrow as pa

from crawlflow.llm import language_id as L
from crawlflow.llm.common import table


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")


WORDS = {"en": "the ring of thing and with for", "de": "und der schon über nicht keit", "es": "ción que los ñ para mente"}


def rows(n=60):
    out = []
    for i in range(n):
        lang = list(WORDS)[i % 3]
        words = WORDS[lang].split()
        out.append((i, " ".join(words[(i * 7 + k * k) % len(words)] for k in range(12)), lang, "x"))
    return out


def test_learns_and_handles_edges(spark):
    docs = frame(spark, rows())
    model = L.learn(docs)
    edge = [(100, None, "en", ""), (101, "", "en", ""), (102, "12 !? 3", None, ""), (103, "DER ÜBER", None, ""), (None, "que los", "es", ""), (103, "DER ÜBER", None, ""), (104, "the thing and " * 50_000, None, "")]
    got = {(r.doc_id, r.lang_pred) for r in L.identify(frame(spark, edge), model).collect()}
    assert got == {(100, "und"), (101, "und"), (102, "und"), (103, "de"), (None, "es"), (104, "en")}
    assert L.identify(frame(spark, edge), model).count() == 7
    assert all(0 <= r.score <= 1 for r in L.identify(docs, model).collect())


def test_nothing_learned_and_empty(spark):
    model = L.learn(frame(spark, [(1, "abc", None, "")]))
    assert [r.lang_pred for r in L.identify(frame(spark, [(1, "abc", "en", "")]), model).collect()] == ["und"]
    assert L.identify(frame(spark, []), model).collect() == []


def test_filter_has_no_false_negatives_and_counts_are_corrected():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 62, 4000).astype(np.uint64))
    half = len(keys) // 2
    model = L.LanguageFilter.build(["a", "b"], {(3, "a"): keys[:half], (3, "b"): keys[half:]}, slots=1 << 12)
    found = model.holders(keys, 3)
    assert ((found[:half] & np.uint64(1)) != 0).all() and ((found[half:] & np.uint64(2)) != 0).all()


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    pred = L.identify(docs, L.learn(L.train_rows(docs))).where("held_out")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = [r.lang_pred == truth[r.doc_id] for r in pred.collect()]
    assert len(got) > 200 and np.mean(got) > 0.97


def test_more_than_64_languages():
    languages = [f"l{k:03d}" for k in range(150)]
    words = [chr(0x4E00 + 3 * k) + chr(0x4E01 + 3 * k) + chr(0x4E02 + 3 * k) for k in range(150)]
    points, rows = L.code_points(pa.array(words))
    grams = {}
    for n in L.SIZES:
        keys, at = L.gram_keys(points, rows, n)
        grams |= {(n, language): keys[at == k] for k, language in enumerate(languages)}
    found = L.LanguageFilter.build(languages, grams).evidence(points, rows, len(words))
    assert found.argmax(axis=1).tolist() == list(range(150))


def test_rare_languages_are_learned(spark):
    docs = [(100 * k + i, (chr(0x4E00 + 2 * k) + chr(0x4E01 + 2 * k) + " ") * 4, f"l{k:02d}") for k in range(66) for i in range(2 if k == 65 else 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = L.learn(frame)
    assert len(model.languages) == 66
    got = {r.doc_id: r.lang_pred for r in L.identify(frame, model).collect()}
    assert got == {d: lang for d, _, lang in docs}


def test_letters_of_all_planes(spark):
    """Letters beyond the second plane are letters too."""
    learned = [(i, chr(0x30010 + i % 7) * 3 + " " + chr(0x31350) * 2, "zh", "") for i in range(30)]
    docs = frame(spark, rows() + [(1000 + i, t, lang, p) for i, t, lang, p in learned])
    got = L.identify(frame(spark, [(1, chr(0x30010) * 3, None, ""), (2, "\U000e0100", None, "")]), L.learn(docs)).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "zh", 2: "und"}
