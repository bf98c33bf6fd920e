"""Every registered query against its SQL."""

import pytest

from streamtab.catalog import QUERIES, SQL
from tests.oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees(spark, con, name):
    # At this scale a few patterns have no occurrence in either engine; the larger check covers them.
    assert compare(spark, con, FOLDER, name) in (None, "agrees but empty")


def test_sql_keys_are_queries():
    assert set(SQL) <= set(QUERIES)
