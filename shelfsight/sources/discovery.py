"""Finding products by keyword and choosing the products whose reviews are wanted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfsight.functions.numbers import number
from shelfsight.operators.ordering import FEW_KEYS, cap_per_group
from shelfsight.operators.products import top_n_products


def discover_by_keyword(
    catalog: DataFrame, keywords: Sequence[str], limit_per_keyword: int = 10
) -> DataFrame:
    """At most ``limit_per_keyword`` products for each keyword, the most reviewed first.

    A product matches if its title contains every word of the keyword, in any case. The keywords are a
    short list, so they are compared within each row and there is no join. A product found by several
    keywords belongs to the first of them: ``discovery_input.keyword``; the others are in
    ``discovery_input.also``. A product that the catalog itself repeats stays repeated.
    """
    keywords = list(dict.fromkeys(keywords))
    title = F.lower("title")
    hits = []
    for keyword in keywords:
        matches = F.lit(True)
        for word in keyword.lower().split():
            matches = matches & title.contains(word)
        hits.append(F.when(matches, F.lit(keyword)))
    found = catalog.withColumn("_keyword", F.explode(F.array_compact(F.array(*hits))))
    order = [number(catalog, "reviews_count").desc_nulls_last(), F.col("asin")]
    best = cap_per_group(found, "_keyword", limit_per_keyword, order, FEW_KEYS)
    # What is left is so many products for each keyword, so this window is small.
    turn = F.array_position(F.lit(keywords), F.col("_keyword"))
    # A row without an asin is known by its content, which is the same if its task runs again.
    content = F.when(F.col("asin").isNull(), F.sha2(F.to_json(F.struct(*[f"`{c}`" for c in catalog.columns])), 256))
    turns = F.array_sort(F.collect_set(turn).over(Window.partitionBy("asin", content)))
    also = F.transform(F.slice("_turns", 2, len(keywords)), lambda t: F.element_at(F.lit(keywords), t.cast("int")))
    return (
        best.withColumn("_turns", turns)
        .where(F.get("_turns", F.lit(0)) == turn)
        .withColumn("discovery_input", F.struct(F.col("_keyword").alias("keyword"), also.alias("also")))
        .drop("_keyword", "_turns")
    )


def url_source(
    spark: SparkSession,
    products: DataFrame | None = None,
    product_urls: Sequence[str] = (),
    top_n: int = 4,
    sort_by: str = "reviews_count",
) -> DataFrame:
    """Urls to collect reviews for: of the top products if there are any, else the given ones."""
    if products is not None and "url" in products.columns and not products.isEmpty():
        return top_n_products(products, top_n, sort_by).select("url")
    return spark.createDataFrame([(u,) for u in product_urls], "url string")
