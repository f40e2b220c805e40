"""Intervals of unchanged prices against the log of all observations."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from shelfsight.sinks.encode import stamp
from shelfsight.sinks.price_intervals import PriceIntervals
from shelfsight.sinks.price_log import append_log, price_changes

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def runs(seed, n, products=30):
    rng, prices = random.Random(seed), {}
    for _ in range(n):
        rows = []
        for p in range(products):
            if rng.random() < 0.2:
                prices[p] = rng.choice([None, 1.0, 2.0, 2.5])
            if rng.random() < 0.85:
                rows += [(f"p{p}", prices.get(p, 1.0))] * rng.choice((1, 1, 2))
        yield rows + [(None, 5.0)]


def rows(df):
    return sorted((tuple(r) for r in df.select("asin", "scraped_at", "best_price", "previous_price", "price_change").collect()), key=str)


def test_changes_equal_those_of_the_log(spark, tmp_path):
    history = PriceIntervals(spark, str(tmp_path / "intervals"))
    for i, observed in enumerate(runs(1, 7)):
        df = spark.createDataFrame(observed, "asin string, best_price double")
        now = START + timedelta(days=i)
        for _ in range(1 + (i in (0, 3, 6))):
            history.append(df, now)
            append_log(stamp(df, now), str(tmp_path / "log"))
        log = spark.read.parquet(str(tmp_path / "log"))
        assert rows(history.changes()) == rows(price_changes(log))
    intervals, observations = history.intervals().count(), log.where("asin IS NOT NULL").count()
    assert intervals < 0.6 * observations
    assert sorted(p.name for p in (tmp_path / "intervals" / "open").iterdir()) == ["run=6", "run=7"]
    at = {r["asin"]: r["price"] for r in history.at(START + timedelta(days=2, hours=5)).collect()}
    third = log.where(F.col("scraped_at") == F.lit(START + timedelta(days=2))).where("asin IS NOT NULL")
    assert at == {r["asin"]: r["best_price"] for r in third.groupBy("asin").agg(F.avg("best_price").alias("best_price")).collect()}


def test_steady_prices_add_nothing(spark, tmp_path):
    history = PriceIntervals(spark, str(tmp_path / "i"))
    df = spark.createDataFrame([(f"p{i}", float(i)) for i in range(50)], "asin string, best_price double")
    for day in range(4):
        history.append(df, START + timedelta(days=day))
    found = history.intervals().collect()
    assert len(found) == 50 and {(r["first_run"], r["last_run"]) for r in found} == {(1, 4)}
    assert {r["to_ts"] - r["from_ts"] for r in found} == {timedelta(days=3)}


def test_order_empty_runs_and_missing_history(spark, tmp_path):
    history = PriceIntervals(spark, str(tmp_path / "i"))
    df = spark.createDataFrame([("a", 1.0)], "asin string, best_price double")
    with pytest.raises(FileNotFoundError):
        history.intervals()
    history.append(df, START)
    history.append(df.limit(0), START + timedelta(days=1))
    history.append(df, START + timedelta(days=2))
    assert [r[:4] for r in rows(history.changes())][1][2:4] == (1.0, 1.0)
    assert history.intervals().count() == 2
    with pytest.raises(ValueError, match="before"):
        history.append(df, START + timedelta(days=1))
    assert history.at(START - timedelta(days=1)).count() == 0
