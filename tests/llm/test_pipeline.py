import importlib
import re

import pytest

from crawlflow.llm import decontamination as D, secret_scan as S, sentence_pieces as P, simhash, toxicity
from crawlflow.llm.common import table
from tests.llm.test_decontamination import brute_distance, tokens
from tests.llm.test_scans import brute_spans
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    pipeline = importlib.import_module("corpus_pipeline")
    out = [table(spark, SF, "documents")]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    assert sorted(map(str, pipeline.run(spark, SF).collect())) == sorted(map(str, out[-1].collect()))
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:5])
    assert all(dict(s.dtypes) == dict(stages[0].dtypes) for s in stages[:5])


def test_toxic_documents_go(spark, stages):
    lexicon = toxicity.learn(stages[0], table(spark, SF, "labels"))
    before = texts(stages[0])
    assert texts(stages[1]) == {d: t for d, t in before.items() if lexicon.score(t or "") < 0.3}


def test_one_of_each_group_stays(stages):
    before = texts(stages[1])
    ids = sorted(before)
    root = brute_components([(d, brute_fingerprint(before[d])) for d in ids])
    assert set(texts(stages[2])) == {d for d, r in zip(ids, root, strict=True) if d == r}
    assert simhash.RADIUS == 2


def test_leaks_go(spark, stages):
    items = [tokens(r.text) for r in table(spark, SF, "benchmark").collect()]
    before = texts(stages[2])
    clean = {d for d, t in before.items() if all(brute_distance(i, tokens(t)) > D.edits(len(i)) for i in items)}
    left = set(texts(stages[3]))
    assert clean <= left and len(left - clean) <= 0.02 * len(before)


def test_secrets_are_masked(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for d, t in before.items():
        assert (after[d] == t) == (not brute_spans(t))
        assert not re.search(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}", after[d])
    assert all(r.n_chars == len(r.text) for r in stages[4].collect() if "[" in r.text)
    assert S.RULES


def test_ids_decode_to_the_texts(stages):
    model = P.lattice(P.model_path())
    after = texts(stages[4])
    for r in stages[5].collect():
        assert r.n_pieces == len(r.ids) and P.decoded(model, r.ids) == after[r.doc_id]
    assert stages[5].count() == len(after)
