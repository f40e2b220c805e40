from datetime import datetime

from pyspark.sql import functions as F

from shelfsight.functions import reviews as R
from shelfsight.operators import reviews as V
from shelfsight.operators.ordering import cap_per_group, number_rows

AS_OF = datetime(2024, 1, 10)


def test_rating_sentiment(column):
    got = column([None, 5.0, 4.0, 3.9, 3.0, 2.9], R.rating_sentiment(F.col("v")), "double")
    assert got == ["Unknown", "Positive", "Positive", "Neutral", "Neutral", "Negative"]


def test_dates_in_several_formats(column):
    texts = ["2024-01-09", "2024-01-09T23:59:00Z", "2024-01-09T23:59:00+02:00", "January 9, 2024", "Jan 9, 2024",
             "1/9/2024", "junk", "", None]
    got = column(texts, F.date_format(R.parse_timestamp(F.col("v")), "yyyy-MM-dd HH:mm"))
    assert got == ["2024-01-09 00:00", "2024-01-09 23:59", "2024-01-09 21:59"] + ["2024-01-09 00:00"] * 3 + [None] * 3


def test_age_is_rounded_down(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-09 23:59:00"), (2, "2024-01-10 01:00:00"), (3, None), (4, "2023-12-11"), (5, "2023-12-10")],
        "i int, created_at string",
    )
    rows = V.with_recency(df, AS_OF).orderBy("i").collect()
    assert [r["review_age_days"] for r in rows] == [0, -1, None, 30, 31]
    assert [r["is_recent"] for r in rows] == [True, True, False, True, False]
    assert V.with_recency(df.select("i"), AS_OF).columns == ["i"]


def test_analysis_by_rating(spark):
    df = spark.createDataFrame([("5",), ("x",)], "rating string")
    rows = V.analyse_by_rating(df).collect()
    assert [r["sentiment"] for r in rows] == ["Positive", "Unknown"]
    assert rows[0]["issues"] == [] and rows[0]["ai_summary"] == ""
    assert V.analyse_by_rating(df.select(F.lit(1).alias("z"))).first()["sentiment"] == "Unknown"


def test_scraped_within(spark):
    df = spark.createDataFrame([("2024-01-03",), ("2024-01-03 00:00:01",), ("2025-01-01",)], "t string").select(
        F.to_timestamp("t").alias("scraped_at")
    )
    assert V.scraped_within(df, AS_OF).count() == 2


KEYS = ["a", None, "a", "b", "a", None]


def test_cap_per_group(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(KEYS)], "seq int, asin string")
    for spread in (None, 1, 8):
        got = cap_per_group(df, "asin", 2, ["seq"], spread)
        assert sorted(r["seq"] for r in got.collect()) == [0, 2, 3]
    assert cap_per_group(df, "asin", 0, ["seq"]).count() == 6
    assert cap_per_group(df, None, 2, ["seq"]).count() == 6


def test_cap_with_a_hot_key_equals_brute_force(spark):
    df = spark.range(0, 9000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("o"), "id",
    )
    rows = sorted((r["k"], r["o"], r["id"]) for r in df.collect())
    expected, seen = set(), {}
    for k, _, i in rows:
        seen[k] = seen.get(k, 0) + 1
        if seen[k] <= 7:
            expected.add(i)
    for spread in (1, 8):
        assert {r["id"] for r in cap_per_group(df, "k", 7, ["o", "id"], spread).collect()} == expected


def test_large_caps_are_spread(spark):
    df = spark.range(0, 6000, 1, 12).select((F.col("id") % 3).alias("k"), "id")
    for n in (60, 1500):
        plan = cap_per_group(df, "k", n, ["id"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert {r["id"] for r in cap_per_group(df, "k", n, ["id"]).collect()} == set(range(3 * n))


def test_cap_limits_each_map_task_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    for spread in (1, 8):
        plan = cap_per_group(df, "k", 5, ["id"], spread)._jdf.queryExecution().executedPlan().toString()
        first_exchange = plan.rindex("Exchange hashpartitioning")
        assert "Partial" in plan[first_exchange:]


def test_reviews_for_broadcasts_only_a_bounded_list(spark):
    reviews = spark.createDataFrame([("u1", 1), ("u2", 2), (None, 3)], "url string, i int")
    urls = spark.createDataFrame([("u1",), ("u1",), (None,)], "url string")
    assert [r["i"] for r in V.reviews_for(reviews, urls, 4).collect()] == [1]
    hinted = V.reviews_for(reviews, urls, 4)._jdf.queryExecution().logical().toString()
    unbounded = V.reviews_for(reviews, urls, 10**9)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted and "broadcast" not in unbounded


def test_number_rows_equals_a_global_order(spark):
    df = spark.range(0, 5000, 1, 7).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("a"), "id")
    got = number_rows(df, [F.desc("a"), "id"]).collect()
    ranked = sorted(((-r["a"], r["id"]) for r in got))
    place = {pair: n for n, pair in enumerate(ranked)}
    assert all(place[(-r["a"], r["id"])] == r["row_index"] for r in got)
    assert number_rows(df.limit(0), ["id"]).count() == 0
