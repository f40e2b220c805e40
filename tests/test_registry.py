"""Every registered query against its SQL on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from shelfsight.registry.oracle import all_sql
from shelfsight.registry.queries import all_queries

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, sql, name):
    df = entry_module.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    ours = sorted(tuple(repr(r[c]) for c in columns) for r in df.collect())
    result = sql.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert ours == sorted(tuple(repr(r[i]) for i in places) for r in result.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
