"""Frequent values with proof against a full count."""

import random

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import frequent as T


def full(df, k):
    counted = df.groupBy("x").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "x").limit(k)
    return [tuple(r) for r in counted.collect()]


def skewed(spark, n, distinct, power):
    rng = random.Random(1)
    rows = [(f"v{int(distinct * rng.random() ** power)}",) for _ in range(n)] + [(None,)] * (n // 20)
    return spark.createDataFrame(rows, "x string").repartition(6)


@pytest.mark.parametrize(("distinct", "power", "tracked", "proved"), [
    (5000, 6, 2000, True), (5000, 1, 2000, False), (20, 1, 100, True), (5000, 6, 16, False),
])
def test_equals_a_full_count(spark, monkeypatch, distinct, power, tracked, proved):
    df = skewed(spark, 20_000, distinct, power)
    counted, real = [], T._first
    monkeypatch.setattr(T, "_first", lambda items, k: counted.append(1) or real(items, k))
    found = [tuple(r) for r in T.frequent(df, F.col("x"), 5, tracked).collect()]
    assert found == full(df, 5)
    # With a proof, the candidates are all that is counted.
    assert proved == (len(counted) == 1 and bool(T.candidates(df.select(F.col("x").alias("item")), 5, tracked)[0]))


def test_no_other_value_is_above_the_bound(spark):
    for power, tracked in ((1, 64), (3, 64), (6, 500)):
        df = skewed(spark, 10_000, 3000, power)
        named, bound = T.candidates(df.select(F.col("x").alias("item")), 3, tracked)
        others = df.where(~F.col("x").isin(named)).groupBy("x").count().agg(F.max("count")).first()[0]
        assert (others or 0) <= bound


def test_fewer_values_than_wanted_nulls_and_no_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    assert [tuple(r) for r in T.frequent(df, F.col("x"), 10).collect()] == full(df, 10)
    assert T.frequent(df.limit(0), F.col("x"), 3).collect() == []
    assert [tuple(r) for r in T.frequent(df.where("x IS NULL"), F.col("x"), 3).collect()] == [(None, 1)]
    numbers = spark.range(1000).select((F.col("id") % 7).alias("x"))
    assert [tuple(r) for r in T.frequent(numbers, F.col("x"), 3).collect()] == full(numbers, 3)
