from pyspark.sql import functions as F

from shelfsight.operators import products as P
from shelfsight.schema import RAW_PRODUCT, order_columns, resolve


def product(**values):
    return tuple(values.get(f) for f in RAW_PRODUCT.fieldNames())


def frame(spark, *rows):
    return spark.createDataFrame([product(**r) for r in rows], RAW_PRODUCT)


def test_enrich_products(spark):
    df = frame(
        spark,
        dict(title="Aluminum Laptop Stand 15 inch", asin="A", initial_price="19.99", final_price="16.99",
             rating="4.8", reviews_count="22776", categories=["Office Products", "Supplies"],
             discovery_input=("laptop stand",), availability="Only 3 left IN STOCK"),
        dict(title="b", asin="B", initial_price="x", categories=[]),
    )
    rows = {r["asin"]: r.asDict() for r in P.enrich_products(df).collect()}
    a, b = rows["A"], rows["B"]
    assert a["search_keyword"] == "laptop stand" and a["main_category"] == "Office Products"
    assert a["discount_percent"] == 15.0 and round(a["discount_amount"], 2) == 3.0
    assert (a["best_price"], a["price_tier"]) == (16.99, "Budget (<$25)")
    assert (a["rating_category"], a["popularity"]) == ("Excellent (4.5-5)", "Best Seller (5K+)")
    assert b["best_price"] is None and b["discount_percent"] == 0.0 and b["main_category"] is None
    kept = P.enrich_products(df, filter_unavailable=True).collect()
    assert [r["asin"] for r in kept] == ["A"]


def test_steps_apply_only_to_present_columns(spark):
    df = spark.createDataFrame([("5", "t")], "final_price string, title string")
    got = P.enrich_products(df)
    assert got.columns == ["final_price", "title", "best_price", "price_tier"]
    assert P.enrich_products(spark.createDataFrame([("t",)], "title string")).columns == ["title"]


def test_empty_input_has_a_stable_schema(spark):
    assert "price_tier" in P.enrich_products(frame(spark)).columns
    assert P.enrich_products(frame(spark)).count() == 0


def test_keyword_from_any_nested_form(spark):
    text = spark.createDataFrame([('{"keyword":"k"}',), ("junk",)], "discovery_input string").coalesce(1)
    good = text.where("discovery_input != 'junk'")
    forms = [
        good.select(F.from_json("discovery_input", "keyword string").alias("discovery_input")),
        good.select(F.from_json("discovery_input", "map<string,string>").alias("discovery_input")),
        good.select(F.parse_json("discovery_input").alias("discovery_input")),
        text,
    ]
    got = [[r["search_keyword"] for r in P.with_search_keyword(f).collect()] for f in forms]
    assert got == [["k"], ["k"], ["k"], ["k", None]]


def test_order_columns_and_resolve(spark):
    df = spark.createDataFrame([(1, 2, 3)], "zeta int, asin int, title int")
    assert order_columns(df).columns == ["title", "asin", "zeta"]
    assert resolve(df, ("x", "asin")) == "asin" and resolve(df, ("x",)) is None


def test_filters(spark):
    df = spark.createDataFrame(
        [("k", "t", 4.0), ("k", "u", None), ("j", "t", 1.0)], "search_keyword string, price_tier string, rating double"
    )
    assert P.filter_products(df).count() == 2
    assert P.filter_products(df, "All", "All", 2.0).count() == 1
    assert P.filter_products(df, keyword="j").count() == 1
    assert P.filter_products(df, tier="u").count() == 0


def test_top_n_puts_nulls_last_and_drops_urls_afterwards(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "u1"), ("b", None, "u2"), ("c", 9.0, None), ("d", 5.0, "u4")], "asin string, reviews_count double, url string"
    )
    assert [r["asin"] for r in P.top_n_products(df, 2).collect()] == ["d"]
    assert {r["asin"] for r in P.top_n_products(df, 4).collect()} == {"a", "b", "d"}
    assert [r["asin"] for r in P.top_n_products(df, 1, sort_by="missing").collect()] == ["a"]


def test_preview_price(spark):
    df = spark.createDataFrame(
        [(1, "t", 0.0, 7.0, 1.0), (2, "t", 3.0, 7.0, 1.0), (3, "t", None, 7.0, 1.0)],
        "i int, title string, final_price double, initial_price double, rating double",
    )
    assert [r["price"] for r in P.product_preview(df, ["i"]).collect()] == [7.0, 3.0, 7.0]


def test_top_k_plans_do_not_sort_the_whole_table(spark):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("asin"), F.col("id").cast("double").alias("reviews_count"),
        F.lit("u").alias("url"),
    )
    plan = P.top_n_products(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame(
        [("k", "t", 4.0, "x"), ("k", "t", float("nan"), "y")],
        "search_keyword string, price_tier string, rating double, other string",
    ).write.parquet(path)
    df = P.filter_products(spark.read.parquet(path), "k", "t", 1.0).select("rating")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(rating,1.0)" in plan and "EqualTo(search_keyword,k)" in plan
    assert "other" not in plan
    assert [r[0] for r in df.collect()] == [4.0]
