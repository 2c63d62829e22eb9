"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, duck

from sparkdesk.plans import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    diff, _, _ = compare(spark, con, FOLDER, QUERIES[name], ORACLES[name])
    assert diff is None, diff


def test_entry_and_names():
    import __spark_entry__ as entry

    assert len(QUERIES) == 93
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
