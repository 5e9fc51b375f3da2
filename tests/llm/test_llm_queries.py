import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from check_oracles import compare, connect  # noqa: E402

from millrace.llm.queries import QUERIES, SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(FOLDER), SimpleNamespace(run=QUERIES[name], sql=SQL[name]), FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
