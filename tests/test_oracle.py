"""Every registered query of the engine against its SQL."""

import pytest
from oracle import compare, connect
from sitelace import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, db, name):
    compare(catalog.QUERIES[name](spark, SF), db, catalog.SQL[name])


def test_entry_imports_and_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
