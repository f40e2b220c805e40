"""The queries against their SQL, and the pipeline stage by stage."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfsight.llm import queries
from tests.llm.helpers import hostile

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sql, name):
    df = queries.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    ours = sorted(tuple(repr(r[c]) for c in columns) for r in df.collect())
    result = sql.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert ours == sorted(tuple(repr(r[i]) for i in places) for r in result.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = corpus_pipeline.run(spark, str(DATA))
    assert 0 < out.count() < docs.count() and out.where(F.col("repeats") < 1).count() == 0
    assert set(docs.columns) < set(out.columns)


def test_stages_take_hostile_rows(spark):
    docs = hostile(spark)
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, str(DATA))
        assert out.columns == docs.columns
        docs = out
    assert sorted(r["doc_id"] for r in docs.collect()) == [2, 5, 6, 8, 9, 10]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(DATA)).count() >= 1
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, hostile(spark).limit(0), str(DATA)).count() == 0
