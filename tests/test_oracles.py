"""Every registered query against its SQL, on the smallest tables."""

import pytest

from tests.conftest import SF
from workloads import load
from workloads.check import compare, connect

NAMES = list(load()[0])


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert "BIRADS" in df.columns and df.limit(1).count() == 1
