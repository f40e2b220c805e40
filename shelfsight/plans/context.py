"""The bundle of small tables that describes the current data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from shelfsight.operators import reports as P
from shelfsight.operators.describe import describe_all
from shelfsight.operators.ordering import top_rows
from shelfsight.operators.products import equals_or_all, filter_products
from shelfsight.schema import PRODUCT_CONTEXT, is_numeric


def filtered(
    products: DataFrame | None,
    reviews: DataFrame | None,
    keyword: str | None = None,
    tier: str | None = None,
    min_rating: float = 0.0,
    sentiment: str | None = None,
) -> tuple[DataFrame | None, DataFrame | None]:
    """Both tables after the report filters; product filters do not touch reviews, or vice versa."""
    shown_products = None if products is None else filter_products(products, keyword, tier, min_rating)
    shown_reviews = None if reviews is None else equals_or_all(reviews, "sentiment", sentiment)
    return shown_products, shown_reviews


def data_context(
    products: DataFrame | None,
    reviews: DataFrame | None,
    product_order: Sequence[str | Column],
    review_order: Sequence[str | Column],
) -> dict[str, Callable[[], DataFrame]]:
    """Statistics and samples of both tables, as far as their columns allow, each made when it is called for."""
    bundle: dict[str, Callable[[], DataFrame]] = {}
    if products is not None:
        named = [c for c in PRODUCT_CONTEXT if c in products.columns]
        numbers = [c for c in products.columns if is_numeric(products, c)]
        bundle["product_statistics"] = lambda: describe_all(products, named or numbers or None)
        bundle["product_sample"] = lambda: top_rows(products, 20, product_order).select(*(named or products.columns))
    if reviews is not None:
        if "sentiment" in reviews.columns:
            bundle["sentiment_distribution"] = lambda: P.sentiment_distribution(reviews)
        if "issues" in reviews.columns:
            bundle["top_issues"] = lambda: P.top_issues(reviews, 15)
        if "themes" in reviews.columns:
            bundle["top_themes"] = lambda: P.top_themes(reviews, 15)
        if "ai_summary" in reviews.columns:
            bundle["review_sample"] = lambda: P.review_sample(reviews, review_order)
    return bundle
