"""Every registered query beside its SQL twin, over whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TESTDATA, compare, duck

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    ok, message = compare(spark, con, FOLDER, name)
    assert ok, message


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["alpha", "beta"]
    assert result.count() == 69
    assert queries()["dust_final_rules_head"](spark, FOLDER).count() == 514
