"""Partial sums beside keyed tables against the reports over the tables themselves."""

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import reports as R
from shelfsight.operators import rollups as C
from shelfsight.sinks.rollup import RolledTable

REVIEW_REPORTS = [
    (R.review_kpis, C.review_kpis), (R.sentiment_distribution, C.sentiment_distribution),
    (R.rating_distribution, C.rating_distribution), (R.analysis_coverage, C.analysis_coverage),
    (R.stored_coverage, C.stored_coverage), (R.recent_counts, C.recent_counts), (R.verified_share, C.verified_share),
]
PRODUCT_REPORTS = [
    (R.product_kpis, C.product_kpis), (R.price_stats, C.price_stats), (R.discounted_count, C.discounted_count),
    (R.count_by_keyword, lambda c: C.value_counts(c, "search_keyword")),
    (R.price_tier_counts, lambda c: C.value_counts(c, "price_tier")), (R.distinct_options, C.distinct_options),
]


def reviews(spark, low, high, word="Positive"):
    ids = F.col("id")
    return spark.range(low, high).select(
        F.when(ids % 13 != 0, F.concat(F.lit("P"), (ids % 40).cast("string"))).alias("asin"),
        F.when(ids % 5 == 0, "Unknown").when(ids % 7 != 0, word).alias("sentiment"),
        F.when(ids % 6 != 0, (ids % 5 + 1).cast("double")).alias("rating"),
        (ids % 3 == 0).alias("is_recent"), F.when(ids % 4 != 0, ids % 8 == 1).alias("verified_purchase"),
    )


def products(spark, low, high):
    ids = F.col("id")
    return spark.range(low, high).select(
        F.concat(F.lit("P"), ids.cast("string")).alias("asin"), F.concat(F.lit("k"), (ids % 3).cast("string")).alias("search_keyword"),
        F.when(ids % 4 != 0, "tier").alias("price_tier"), F.when(ids % 5 != 0, (ids * 1.5)).alias("best_price"),
        (ids % 5).cast("double").alias("rating"), (ids % 9 - 2).cast("double").alias("discount_percent"),
    )


def rows(df):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def same(table, reports):
    whole, cube = table.read(), table.totals()
    for over_table, over_cube in reports:
        one, other = over_table(whole), over_cube(cube)
        assert one.columns == other.columns and rows(one) == rows(other), over_table.__name__


def test_review_reports_after_upserts(spark, tmp_path):
    table = RolledTable(spark, str(tmp_path / "t"), "asin", C.REVIEW_CUBE, 8)
    for batch in (reviews(spark, 0, 300), reviews(spark, 0, 20, "Negative"), reviews(spark, 300, 330, "Neutral")):
        table.upsert(batch)
        same(table, REVIEW_REPORTS)
    table.replace_all(reviews(spark, 0, 10))
    same(table, REVIEW_REPORTS)


def test_product_reports_after_upserts(spark, tmp_path):
    table = RolledTable(spark, str(tmp_path / "t"), "asin", C.PRODUCT_CUBE, 8)
    for batch in (products(spark, 1, 60), products(spark, 50, 70).withColumn("best_price", F.lit(0.5)), products(spark, 59, 60)):
        table.upsert(batch)
        same(table, PRODUCT_REPORTS)


def test_only_partial_rows_are_read_and_only_new_files_aggregated(spark, tmp_path):
    table = RolledTable(spark, str(tmp_path / "t"), "asin", C.REVIEW_CUBE, 8)
    table.upsert(reviews(spark, 0, 300))
    assert all("/rollup/" in f for f in table.totals().inputFiles())
    table.table.upsert(reviews(spark, 1, 2))
    asked = []
    read_parts = table.table.read_parts
    table.table.read_parts = lambda parts, schema: asked.append(len(parts)) or read_parts(parts, schema)
    table.refresh()
    table.refresh()
    # One key: the file with its new rows and the one with what is left of its old one.
    assert asked == [2]
    same(table, REVIEW_REPORTS)


def test_a_run_that_died_between_table_and_cube(spark, tmp_path):
    table = RolledTable(spark, str(tmp_path / "t"), "asin", C.REVIEW_CUBE, 8)
    table.upsert(reviews(spark, 0, 100))
    table.table.upsert(reviews(spark, 0, 30, "Negative"))
    table.table.upsert(reviews(spark, 100, 110))
    table.refresh()
    same(table, REVIEW_REPORTS)


@pytest.mark.parametrize("missing", [("rating",), ("is_recent", "verified_purchase")])
def test_missing_columns_and_empty_tables(spark, tmp_path, missing):
    table = RolledTable(spark, str(tmp_path / "t"), "asin", C.REVIEW_CUBE, 8)
    assert table.totals is not None and not table.table.exists()
    table.upsert(reviews(spark, 0, 50).drop(*missing))
    assert rows(C.review_kpis(table.totals())) == rows(R.review_kpis(table.read()))
    empty = RolledTable(spark, str(tmp_path / "e"), "asin", C.REVIEW_CUBE, 8)
    empty.replace_all(reviews(spark, 0, 0))
    assert C.review_kpis(empty.totals()).first()["reviews"] == 0
