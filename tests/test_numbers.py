import math

from pyspark.sql import functions as F

from shelfsight.functions import numbers as N

INF = float("inf")


def test_to_number(column):
    texts = ["19.99", " 19.99 ", "$5", "1,000", "", "1e3", "inf", "-inf", "nan", "1d", "1f", "2D ", "0x10", "1_0", None]
    expected = [19.99, 19.99, None, None, None, 1000.0, INF, -INF, None, None, None, None, None, None, None]
    assert column(texts, N.to_number(F.col("v"))) == expected


def test_nan_in_a_number_column_is_null(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (None,)], "v double")
    assert df.agg(F.avg(N.number(df, "v"))).first()[0] == 2.0


def test_price_tier(column):
    prices = [-1.0, 0.0, 0.01, 25.0, 25.01, 50.0, 100.0, 250.0, 251.0, INF, None]
    expected = [None, None, "Budget (<$25)", "Budget (<$25)", "Mid ($25-50)", "Mid ($25-50)",
                "Premium ($50-100)", "High-end ($100-250)", "Luxury ($250+)", "Luxury ($250+)", None]
    assert column(prices, N.price_tier(F.col("v")), "double") == expected


def test_rating_category(column):
    ratings = [0.0, 3.0, 3.01, 4.0, 4.5, 5.0, 5.1, None]
    expected = [None, "Low (<3)", "Average (3-4)", "Average (3-4)", "Good (4-4.5)", "Excellent (4.5-5)", None, None]
    assert column(ratings, N.rating_category(F.col("v")), "double") == expected


def test_popularity(column):
    counts = [0.0, 1.0, 100.0, 101.0, 500.0, 1000.0, 5000.0, 5001.0, None]
    expected = [None, "New (<100)", "New (<100)", "Growing (100-500)", "Growing (100-500)", "Popular (500-1K)",
                "Very Popular (1K-5K)", "Best Seller (5K+)", None]
    assert column(counts, N.popularity(F.col("v")), "double") == expected


def test_rounding_is_half_even(column):
    got = column([0.25, 0.35, 12.25, 12.35], N.round_half_even(F.col("v")), "double")
    assert got == [0.2, 0.4, 12.2, 12.4]


def test_discount_percent(spark):
    rows = [(10.0, 8.0), (0.0, 0.0), (0.0, 5.0), (0.0, -5.0), (None, 3.0), (10.0, None), (10.0, 12.0), (INF, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(N.discount_percent(F.col("a"), F.col("b"))).collect()]
    assert got == [20.0, 0.0, -INF, INF, 0.0, 0.0, -20.0, 0.0]
    assert not any(math.isnan(x) for x in got)
