"""Every registered query against its SQL, at the smallest scale."""

import pytest
from check_oracles import compare, connect

from millrace.plans.registry import all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, con, name):
    query = all_queries()[name]
    assert query.sql, "every query states its result in SQL"
    problem = compare(spark, con, query, FOLDER)
    assert problem in (None, "both empty")


def test_entry_runs(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
