"""Every query of the subpackage: against its SQL, or by the same brute force as the operator's tests."""

import pytest

from streamtab.llm.queries import QUERIES, SQL
from tests import oracle
from tests.llm import test_lm, test_mix, test_partenum, test_tokens
from tests.llm.helpers import listed

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.duck(FOLDER)


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, con, name, monkeypatch):
    monkeypatch.setitem(oracle.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(oracle.SQL, name, SQL[name])
    assert oracle.compare(spark, con, FOLDER, name) is None


def documents(spark):
    return [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_jaccard_join(spark):
    assert listed(QUERIES["op4_ngram_jaccard_join"](spark, FOLDER)) == test_partenum.brute([d[:2] for d in documents(spark)])


def test_token_files(spark):
    assert listed(QUERIES["op6_token_files"](spark, FOLDER)) == test_tokens.brute([d[:2] for d in documents(spark)])


def test_lm_scoring(spark):
    assert test_lm.picked(QUERIES["op7_lm_scoring"](spark, FOLDER)) == test_lm.base([d[:2] for d in documents(spark)])


def test_source_mix(spark):
    sources = {d[0]: d[2] for d in documents(spark)}
    rows = [r.asDict() | {"source": sources[r["doc_id"]]} for r in QUERIES["op10_source_mix"](spark, FOLDER).collect()]
    test_mix.check(rows, documents(spark))


def test_names():
    assert [n for n in QUERIES if n.startswith("op")] and {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in QUERIES and set(SQL) <= set(QUERIES)
