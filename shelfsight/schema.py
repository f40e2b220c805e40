"""Schema-time decisions: alternative column names, projections, table kinds.

Nothing here touches data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Columns that say where in a snapshot a record came from.
PLACE = ("file", "seq", "pos")

# Alternative physical names, first present wins.
REVIEW_KEY = ("asin", "product_asin", "url")
PRODUCT_KEY = ("asin",)
REVIEW_TEXT = ("review_text", "text", "body", "content", "review")
REVIEW_TEXT_AT_GATE = ("review_text", "text", "body", "content")
REVIEW_DATE = ("date", "review_date", "created_at", "timestamp", "review_posted_date")
VERIFIED = ("verified_purchase", "is_verified")

# Columns moved to the front of a product table.
PRODUCT_COLUMNS_FIRST = (
    "title", "brand", "asin", "url",
    "initial_price", "final_price", "currency",
    "rating", "reviews_count", "bought_past_month",
    "availability", "categories",
    "seller_name", "image_url",
    "discovery_input",
)

# Columns of the four display projections.
PRODUCT_DISPLAY = (
    "title", "brand", "best_price", "rating", "reviews_count",
    "price_tier", "rating_category", "popularity", "discount_percent",
    "search_keyword",
)
REVIEW_DISPLAY = (
    "rating", "sentiment", "ai_summary", "issues", "themes",
    "review_text", "text", "body",
    "is_verified", "verified_purchase",
    "review_posted_date", "date",
)
PRODUCT_CONTEXT = (
    "title", "brand", "best_price", "rating", "reviews_count",
    "price_tier", "discount_percent", "search_keyword", "popularity",
)
REVIEW_CONTEXT = ("rating", "sentiment", "ai_summary", "issues")

RAW_PRODUCT = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("initial_price", T.StringType()),
    T.StructField("final_price", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("reviews_count", T.StringType()),
    T.StructField("bought_past_month", T.StringType()),
    T.StructField("availability", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("seller_name", T.StringType()),
    T.StructField("image_url", T.StringType()),
    T.StructField("discovery_input", T.StructType([T.StructField("keyword", T.StringType())])),
])

RAW_REVIEW = T.StructType([
    T.StructField("asin", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("verified_purchase", T.BooleanType()),
])


def resolve(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """The first candidate that is a column of ``df``."""
    return next((name for name in candidates if name in df.columns), None)


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in names if name in df.columns])


def order_columns(df: DataFrame, first: Iterable[str] = PRODUCT_COLUMNS_FIRST) -> DataFrame:
    """Move known columns to the front and keep all others in source order."""
    lead = [name for name in first if name in df.columns]
    return df.select(*lead, *[name for name in df.columns if name not in lead])


def classify_schema(df: DataFrame) -> str:
    """``"reviews"`` or ``"products"``, judged by column names alone."""
    return "reviews" if resolve(df, ("sentiment", "ai_summary")) else "products"


def is_numeric(df: DataFrame, name: str) -> bool:
    """Whether a column is stored as a number or a flag."""
    return isinstance(df.schema[name].dataType, (T.NumericType, T.BooleanType))
