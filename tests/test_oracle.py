"""Every registered query with SQL, against DuckDB on the same tables."""

import pytest

from marlstone.plans import load
from tests.oracle import connect, differences

QUERIES = load()


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_equals_sql(name, spark, folder, db):
    assert differences(QUERIES[name].run(spark, folder), db, QUERIES[name].sql) == ""


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_runs(name, spark, folder):
    assert QUERIES[name].run(spark, folder).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
