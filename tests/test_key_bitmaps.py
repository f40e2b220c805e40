"""Distinct counts from bitmaps against sets."""

import random

from pyspark.sql import functions as F

from shelfsight.sinks.key_bitmaps import KeyBitmaps


def test_counts_over_runs_equal_sets(spark, tmp_path):
    rng, store, sets = random.Random(1), KeyBitmaps(spark, str(tmp_path / "b")), {}
    for run in ("a", "b", "c", "b"):
        rows = [(f"P{rng.randrange(300)}" if rng.random() < 0.95 else None, rng.choice(["x", "y", None])) for _ in range(200)]
        store.add(spark.createDataFrame(rows, "asin string, sentiment string"), run, F.col("sentiment"))
        sets[run] = {r for r in rows if r[0] is not None}
    for runs in (None, ["a"], ["a", "b"], ["c", "none"], []):
        chosen = set().union(*[sets[r] for r in sets if runs is None or r in runs])
        assert store.count(runs).first()[0] == len({k for k, _ in chosen})
        groups = {r["group"]: r["products"] for r in store.count_by_group(runs).collect()}
        assert groups == {g: len({k for k, s in chosen if s == g}) for g in {s for _, s in chosen}}
    assert store.both("a", "b").first()[0] == len({k for k, _ in sets["a"]} & {k for k, _ in sets["b"]})
    assert store.both("a", "a").first()[0] == len({k for k, _ in sets["a"]})
    assert store.both("a", "none").first()[0] == 0


def test_numbers_are_kept_and_cover_many_buckets(spark, tmp_path):
    store = KeyBitmaps(spark, str(tmp_path / "b"))
    store.add(spark.range(70_000).select(F.col("id").cast("string").alias("asin")), "first")
    before = {r["key"]: r["number"] for r in store._numbers.read().where("key < '2'").collect()}
    store.add(spark.range(60_000, 100_000).select(F.col("id").cast("string").alias("asin")), "second")
    after = {r["key"]: r["number"] for r in store._numbers.read().collect()}
    assert all(after[k] == n for k, n in before.items()) and len(set(after.values())) == 100_000
    assert store.count().first()[0] == 100_000 and store.both("first", "second").first()[0] == 10_000
    assert all("/bitmaps/" in f for f in store.count().inputFiles())
    assert store._bitmaps.read().count() < 10


def test_no_rows(spark, tmp_path):
    store = KeyBitmaps(spark, str(tmp_path / "b"))
    assert store.count().first()[0] == 0
    store.add(spark.createDataFrame([], "asin string"), "empty")
    store.add(spark.createDataFrame([(None,)], "asin string"), "null")
    assert store.count().first()[0] == 0 and store.count_by_group().count() == 0
