"""Quantiles from sketches and scans against sorted lists."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import quantiles as U

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def expected(values, p):
    values = sorted(v for v in values if v is not None)
    exact = (len(values) - 1) * p
    low, high = values[math.floor(exact)], values[math.ceil(exact)]
    return low if low == high else low + (high - low) * (exact - math.floor(exact))


def check(spark, columns):
    names = list(columns)
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"`{n}` double" for n in names))
    stats, searches = U.summaries(df.repartition(5), PROBABILITIES)
    found = U.sketched_quantiles(df, searches)
    for n in names:
        if any(v is not None for v in columns[n]):
            assert stats[n]["count"] == sum(v is not None for v in columns[n])
            for p in PROBABILITIES:
                assert found[n, p] == pytest.approx(expected(columns[n], p), rel=1e-12), (n, p)
        else:
            assert n not in stats


def columns(seed, n):
    rng = random.Random(seed)
    return {
        "even": [rng.random() for _ in range(n)],
        "skewed": [rng.choice([0.0, 0.0, 0.0, rng.expovariate(1)]) for _ in range(n)],
        "one": [7.0] * n,
        "few.dots": [float(rng.randrange(5)) if rng.random() < 0.8 else None for _ in range(n)],
        "far": [rng.choice([-1e300, 1e300, rng.gauss(0, 1)]) for _ in range(n)],
        "none": [None] * n,
    }


def test_listed_at_once(spark):
    check(spark, columns(1, 500))
    check(spark, {"single": [3.5], "other": [None]})


@pytest.mark.parametrize(("listed", "sketch"), [(50, 256), (400, 64), (0, 512)])
def test_brackets_are_narrowed(spark, monkeypatch, listed, sketch):
    monkeypatch.setattr(U, "LISTED", listed)
    monkeypatch.setattr(U, "SKETCH", sketch)
    monkeypatch.setattr(U, "MARGIN", 8 / sketch)
    if listed == 0:
        # Nothing may be listed unless it is one value; so only such columns end.
        check(spark, {k: v for k, v in columns(2, 3000).items() if k in ("one", "few.dots", "none")})
    else:
        check(spark, columns(2, 3000))


def test_a_sketch_that_is_off_is_found_out(spark, monkeypatch):
    monkeypatch.setattr(U, "LISTED", 100)
    rows = [float(i) for i in range(3000)]
    df = spark.createDataFrame([(r,) for r in rows], "x double")
    _, searches = U.summaries(df, (0.5,))
    wrong = [U.replace(s, least=2000.0, most=2050.0, expected=0) for s in searches]
    assert U.sketched_quantiles(df, wrong) == {("x", 0.5): 1499.5}


def test_what_is_shuffled_does_not_grow_with_the_values(spark, monkeypatch):
    monkeypatch.setattr(U, "LISTED", 1000)
    df = spark.range(0, 200_000, 1, 8).select((F.col("id") * 1.0).alias("x"))
    listed = []
    real = U._listed
    monkeypatch.setattr(U, "_listed", lambda values, searches: listed.append(
        [values.where(F.col("x").between(s.least, s.most)).count() for s in searches]) or real(values, searches))
    _, searches = U.summaries(df, (0.25, 0.5))
    assert U.sketched_quantiles(df, searches) == {("x", 0.25): 49999.75, ("x", 0.5): 99999.5}
    assert listed and all(n <= 1000 for n in listed[-1])
