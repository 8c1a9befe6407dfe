"""Every registered query runs; those with SQL give the same rows as DuckDB."""

import pytest

from cohortspark.queries import ORACLES, QUERIES
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    rows, problem = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert problem is None, problem
    assert rows >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:2] == ["subject", "t"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
