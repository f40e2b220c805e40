from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfsight.operators import reports as R
from shelfsight.operators.describe import describe_all, describe_numeric, exact_quantiles
from shelfsight.plans.context import data_context


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_kpis_skip_missing_columns_and_nulls(spark):
    df = spark.createDataFrame([("1.5", None), ("x", 4.0)], "final_price string, rating double")
    assert rows(R.product_kpis(df)) == [(2, 1.5, 4.0, None)]


def test_null_sentiment_stays_in_the_denominator(spark):
    df = spark.createDataFrame([("Negative",), ("Positive",), (None,), (None,)], "sentiment string")
    assert rows(R.review_kpis(df)) == [(4, None, 25.0, 25.0)]
    assert rows(R.sentiment_distribution(df)) == [("Negative", 1, 25.0), ("Positive", 1, 25.0)]
    assert rows(R.analysis_coverage(df)) == [(4, 4, 100.0)]
    assert rows(R.stored_coverage(df)) == [(4, 2)]


def test_value_counts_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "price_tier string")
    assert rows(R.price_tier_counts(df)) == [("c", 2), ("a", 1), ("b", 1)]


def test_top_items_from_arrays_and_text(spark):
    arrays = spark.createDataFrame([(["a", "b"],), (["a"],), (None,)], "issues array<string>")
    texts = spark.createDataFrame([('["a","b"]',), ("['a']",), ("bad",)], "issues string")
    for df in (arrays, texts):
        assert rows(R.top_issues(df)) == [("a", 2), ("b", 1)]


def test_first_issues_are_in_row_order_with_repeats(spark):
    df = spark.createDataFrame([(2, ["z", "a"]), (1, ["a"]), (3, [])], "seq int, issues array<string>")
    assert rows(R.first_issues(df, ["seq"])) == [(1, "a"), (2, "z"), (3, "a")]
    assert rows(R.first_issues(df, [F.desc("seq")], 2)) == [(1, "z"), (2, "a")]


def test_review_summary(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "Positive", ["x"]), (2, 1.0, "Negative", [])], "seq int, rating double, sentiment string, issues array<string>"
    )
    assert rows(R.review_summary(df, ["seq"])) == [(2, 3.0, 50.0, False, [], ["x"])]


def test_verified_share_of_all_rows(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "is_verified boolean")
    assert rows(R.verified_share(df)) == [(2, 50.0)]


def test_negative_rate(spark):
    at = datetime(2024, 1, 9)
    data = [("a", "n", "Negative", at), ("a", "n", "Positive", at), ("b", "m", "Positive", at),
            ("c", "o", "Negative", datetime(2023, 12, 1))]
    df = spark.createDataFrame(data, "asin string, product_name string, sentiment string, scraped_at timestamp")
    assert rows(R.negative_rate(df, datetime(2024, 1, 10))) == [("a", "n", 0.5, 2)]


def test_summaries_by_sentiment(spark):
    data = [(i, s, 1.0, "t", ["p"]) for i, s in enumerate(["Negative"] * 12 + ["Unknown"] * 3 + ["Neutral"])]
    data.append((99, "Neutral", 3.0, "", []))
    df = spark.createDataFrame(data, "seq int, sentiment string, rating double, ai_summary string, issues array<string>")
    got = R.summaries_by_sentiment(df, ["seq"]).collect()
    assert sorted(r["seq"] for r in got) == list(range(10)) + [15]
    assert {(r["sentiment"], r["group_size"]) for r in got} == {("Negative", 12), ("Neutral", 1)}
    assert got[0]["line"] == "1.0/5 -- t | Issues: p"
    bare = R.summaries_by_sentiment(df.drop("rating", "issues"), ["seq"])
    assert {r["line"] for r in bare.collect()} == {"N/A/5 -- t"}


def test_distinct_options(spark):
    df = spark.createDataFrame([("k", "t"), ("k", None), ("j", "t")], "search_keyword string, price_tier string")
    assert rows(R.distinct_options(df)) == [("price_tier", "t"), ("search_keyword", "j"), ("search_keyword", "k")]


def test_describe_equals_pandas(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({
        "name": rng.choice(["u", "v", "w", None], 501, p=[0.5, 0.2, 0.2, 0.1]),
        "x": rng.normal(size=501), "y": rng.integers(0, 9, 501).astype(float), "z": [1.0] * 501,
    })
    frame.loc[::7, "x"] = None
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "name string, x double, y double, z double")
    got = {r["column"]: r.asDict() for r in describe_all(df.repartition(5)).collect()}
    want = frame.describe(include="all")
    for column in ("x", "y", "z"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert abs(got[column][ours] - want[column][theirs]) < 1e-9, (column, ours)
        assert got[column]["top"] is None
    assert (got["name"]["count"], got["name"]["unique"], got["name"]["top"], got["name"]["freq"]) == tuple(
        want["name"][["count", "unique", "top", "freq"]])
    assert got["name"]["mean"] is None
    assert describe_numeric(df, ["x"]).columns[:2] == ["column", "count"]


def test_exact_quantiles_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4001).select(
            F.lit("c").alias("column"), (F.col("id") * 3).cast("double").alias("value"), F.lit(1).alias("n")
        )
        got = {r["probability"]: r["quantile"] for r in exact_quantiles(df, (0.0, 0.1, 0.5, 0.999, 1.0)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {0.0: 0.0, 0.1: 1200.0, 0.5: 6000.0, 0.999: 11988.0, 1.0: 12000.0}


def test_data_context_follows_the_columns(spark):
    products = spark.createDataFrame([("t", 1.0)], "title string, best_price double")
    reviews = spark.createDataFrame([("Positive", "ok", 5.0)], "sentiment string, ai_summary string, rating double")
    bundle = data_context(products, reviews, ["title"], ["rating"])
    assert set(bundle) == {"product_statistics", "product_sample", "sentiment_distribution", "review_sample"}
    assert bundle["product_sample"]().columns == ["title", "best_price"]
    assert bundle["review_sample"]().columns == ["rating", "sentiment", "ai_summary"]
