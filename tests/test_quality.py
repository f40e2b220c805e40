import uuid

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import quality as Q
from shelfsight.staging import stage


def failed(df, expectations):
    return {r["name"] for r in Q.evaluate(df, expectations(df)).collect() if not r["passed"]}


def test_raw_products(spark):
    schema = "title string, url string, final_price string, asin string"
    good = spark.createDataFrame([("t", "u", "0", "a"), ("t", None, "x", None), ("t", "u", "1", None)], schema)
    assert failed(good, Q.raw_products) == set()
    bad = spark.createDataFrame([(None, "u", "-1", "a"), ("t", "u", "1", "a")], schema)
    assert failed(bad, Q.raw_products) == {"null_titles", "negative_prices", "duplicate_asins"}
    assert failed(bad.drop("url"), Q.raw_products) >= {"has_url"}
    assert failed(good.limit(0), Q.raw_products) == {"not_empty"}


def test_raw_reviews(spark):
    df = spark.createDataFrame([("a", "0.5", "t"), ("b", "junk", "t")], "asin string, rating string, body string")
    assert failed(df, Q.raw_reviews) == {"ratings_outside_1_5"}
    assert failed(df.withColumnRenamed("body", "review"), Q.raw_reviews) == {"has_text", "ratings_outside_1_5"}
    report = {r["name"]: r["observed"] for r in Q.evaluate(df, Q.raw_reviews(df)).collect()}
    assert report["products_covered"] == 2.0


def test_enriched_products(spark):
    schema = "best_price double, price_tier string, rating double, discount_percent double"
    df = spark.createDataFrame([(1.0, "t", 5.0, 0.0), (0.0, None, 5.5, float("-inf"))], schema)
    assert failed(df, Q.enriched_products) == {"prices_not_positive", "ratings_outside_0_5", "negative_discounts"}
    assert failed(df.drop("best_price"), Q.enriched_products) >= {"has_best_price"}


def test_analysed_reviews(spark):
    schema = "sentiment string, issues array<string>, themes array<string>, ai_summary string"
    df = spark.createDataFrame([("Unknown", [], [], ""), ("Unknown", [], [], ""), ("Great", [], [], "")], schema)
    assert failed(df, Q.analysed_reviews) == {"invalid_sentiments", "coverage_pct"}
    half = spark.createDataFrame([("Unknown", [], [], ""), (None, [], [], "")], schema)
    assert failed(half, Q.analysed_reviews) == set()


def test_enforce(spark):
    df = spark.createDataFrame([("t", "u")], "title string, url string")
    assert len(Q.enforce(Q.evaluate(df, Q.raw_products(df)), "g")) == 4
    with pytest.raises(Q.GateFailure, match="g: not_empty"):
        Q.enforce(Q.evaluate(df.limit(0), Q.stored_products(df)), "g")


def test_a_gate_is_one_aggregation(spark):
    schema = "sentiment string, issues string, themes string, ai_summary string"
    df = spark.createDataFrame([("Unknown", "", "", "")], schema)
    plan = Q.evaluate(df, Q.analysed_reviews(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def _jobs(spark, action):
    """How many jobs an action runs."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_observed_gates_equal_evaluated_ones(spark):
    rows = [("t", "u", 1.5, "A", 4.0, "tier", 5.0, "Positive", "[]"), (None, "u", -2.0, "A", 9.0, None, -1.0, "odd", None)]
    df = spark.createDataFrame(rows, "title string, url string, final_price double, asin string, rating double, "
                               "price_tier string, discount_percent double, sentiment string, issues string")
    df = df.withColumns({"best_price": F.col("final_price"), "review_text": F.col("title")})
    gates = (Q.raw_products, Q.raw_reviews, Q.enriched_products, Q.analysed_reviews, Q.stored_products, Q.stored_reviews)
    for frame in (df, df.limit(0), df.where("rating < 5"), df.drop("asin", "rating", "sentiment")):
        for gate in gates:
            wanted = [r.asDict() for r in Q.evaluate(frame, gate(frame)).collect()]
            try:
                stored, found = Q.stage_checked(frame, "gate", gate, "gate")
                assert found == wanted and all(r["passed"] for r in found)
                assert stored.count() == frame.count()
            except Q.GateFailure as failure:
                failed = [r for r in wanted if not r["passed"]]
                assert failed and all(f"{r['name']}: {r['observed']}" in str(failure) for r in failed)


def test_a_gate_costs_no_job_of_its_own(spark):
    df = spark.range(100).select(
        F.lit("t").alias("sentiment"), F.lit("").alias("issues"), F.lit("").alias("themes"), F.lit("").alias("ai_summary")
    ).withColumn("sentiment", F.lit("Positive"))
    alone = _jobs(spark, lambda: stage(df, "alone"))
    assert _jobs(spark, lambda: Q.stage_checked(df, "gate", Q.analysed_reviews, "gate")) == alone
    separate = _jobs(spark, lambda: Q.enforce(Q.evaluate(stage(df, "apart"), Q.analysed_reviews(df)), "gate"))
    assert separate > alone
