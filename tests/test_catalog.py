"""Every registered query with SQL equals that SQL on the smallest given tables."""

from pathlib import Path

import pytest
from oracle import compare, connect

from scoreloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(SF).exists():
        pytest.skip("given tables are not here")
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) == []


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
