"""Cleaning, enriching and selecting products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.functions import numbers as N
from shelfsight.functions.text import short_title
from shelfsight.operators.ordering import top_rows
from shelfsight.schema import PRODUCT_DISPLAY, is_numeric, select_existing


def with_search_keyword(df: DataFrame) -> DataFrame:
    """The keyword a product was found by, from its nested ``discovery_input``."""
    if "discovery_input" not in df.columns:
        return df
    kind = df.schema["discovery_input"].dataType
    if isinstance(kind, T.StructType):
        has_keyword = "keyword" in kind.fieldNames()
        keyword = F.col("discovery_input.keyword") if has_keyword else F.lit(None).cast("string")
    elif isinstance(kind, T.MapType):
        keyword = F.try_element_at("discovery_input", F.lit("keyword"))
    elif isinstance(kind, T.VariantType):
        keyword = F.try_variant_get("discovery_input", "$.keyword", "string")
    else:
        keyword = F.get_json_object(F.col("discovery_input").cast("string"), "$.keyword")
    return df.withColumn("search_keyword", keyword)


def _is_array(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


def enrich_products(df: DataFrame, filter_unavailable: bool = False) -> DataFrame:
    """Coerce numbers and add discount, best price, bands and main category.

    Each step applies only if its input columns exist. The result is one narrow projection.
    """
    df = with_search_keyword(df)
    numeric = [c for c in ("initial_price", "final_price", "rating", "reviews_count") if c in df.columns]
    df = df.withColumns({name: N.number(df, name) for name in numeric})

    prices = [c for c in ("final_price", "initial_price") if c in df.columns]
    added: dict[str, Column] = {}
    if len(prices) == 2:
        initial, final = F.col("initial_price"), F.col("final_price")
        added["discount_amount"] = N.nan_to_null(initial - final)
        added["discount_percent"] = N.discount_percent(initial, final)
    if prices:
        best = F.coalesce(*[F.col(c) for c in prices])
        added["best_price"] = best
        added["price_tier"] = N.price_tier(best)
    if "rating" in df.columns:
        added["rating_category"] = N.rating_category(F.col("rating"))
    if "reviews_count" in df.columns:
        added["popularity"] = N.popularity(F.col("reviews_count"))
    if "categories" in df.columns:
        first = F.get("categories", F.lit(0)) if _is_array(df, "categories") else F.lit(None).cast("string")
        added["main_category"] = first
    df = df.withColumns(added) if added else df
    return available_only(df) if filter_unavailable else df


def available_only(df: DataFrame) -> DataFrame:
    """Products whose availability mentions "in stock", in any case."""
    if "availability" not in df.columns:
        return df
    return df.where(F.coalesce(F.lower("availability").contains("in stock"), F.lit(False)))


def equals_or_all(df: DataFrame, name: str, wanted: str | None) -> DataFrame:
    """Equality filter, where ``None`` or ``"All"`` means no filter."""
    if wanted is None or wanted == "All" or name not in df.columns:
        return df
    return df.where(F.col(name) == wanted)


def filter_products(
    df: DataFrame,
    keyword: str | None = None,
    tier: str | None = None,
    min_rating: float = 0.0,
) -> DataFrame:
    """Report filters; the rating filter always applies, so unrated products always drop."""
    df = equals_or_all(df, "search_keyword", keyword)
    df = equals_or_all(df, "price_tier", tier)
    if "rating" not in df.columns:
        return df
    if is_numeric(df, "rating"):
        # Written on the bare column, so that the scan can skip row groups.
        return df.where((F.col("rating") >= min_rating) & ~F.isnan("rating"))
    return df.where(N.number(df, "rating") >= min_rating)


def top_n_products(
    df: DataFrame,
    n: int = 4,
    sort_by: str = "reviews_count",
    tie_break: Sequence[str] = ("asin",),
) -> DataFrame:
    """The ``n`` first products by ``sort_by`` descending, and of those the ones with a url.

    Numbers that are stored as text are ordered as numbers. If the column is missing the tie-break order alone
    decides.
    """
    order: list[Column] = [F.col(c).asc_nulls_last() for c in tie_break if c in df.columns]
    if sort_by in df.columns:
        order[:0] = _descending(df, sort_by)
    return top_rows(df, n, order).dropna(subset=["url"])


def _descending(df: DataFrame, name: str) -> list[Column]:
    """By the number a column holds, then, among what is no number, by its text."""
    if is_numeric(df, name) or not isinstance(df.schema[name].dataType, T.StringType):
        return [F.col(name).desc_nulls_last()]
    return [N.number(df, name).desc_nulls_last(), F.col(name).desc_nulls_last()]


def top3_by_rating(df: DataFrame) -> DataFrame:
    return top_rows(
        df, 3,
        [F.col("rating").desc_nulls_last(), F.col("reviews_count").desc_nulls_last(), F.col("asin")],
    )


def price_comparison(df: DataFrame) -> DataFrame:
    """Priced products with a short title, cheapest first."""
    return (
        df.dropna(subset=["best_price"])
        .select(short_title(F.col("title")).alias("short_title"), "best_price", "asin")
        .orderBy("best_price", "asin")
    )


def rating_comparison(df: DataFrame) -> DataFrame:
    """Rated products with a short title, lowest rating first."""
    return (
        df.dropna(subset=["rating"])
        .select(short_title(F.col("title")).alias("short_title"), "rating", "asin")
        .orderBy("rating", "asin")
    )


def price_vs_rating(df: DataFrame) -> DataFrame:
    """Products with both a price and a rating, as scatter points."""
    return select_existing(
        df.dropna(subset=["best_price", "rating"]),
        ("best_price", "rating", "reviews_count", "title"),
    )


def product_table(df: DataFrame) -> DataFrame:
    """The display columns, most reviewed first."""
    shown = [c for c in PRODUCT_DISPLAY if c in df.columns]
    lead = "reviews_count" if "reviews_count" in shown else shown[0]
    ties = [F.col("asin")] if "asin" in df.columns else []
    return df.orderBy(*_descending(df, lead), *ties).select(*shown)


def product_preview(df: DataFrame, order: Sequence[str | Column], n: int = 3) -> DataFrame:
    """A few products with the price to show: the final one unless it is zero or unknown."""
    price = F.coalesce(F.nullif(F.col("final_price"), F.lit(0.0)), F.col("initial_price"))
    return top_rows(df, n, order).select(
        F.substring("title", 1, 50).alias("title"), price.alias("price"), "rating"
    )


def selection_preview(top: DataFrame) -> DataFrame:
    """The products chosen for review collection, with their review counts."""
    return top.select(F.substring("title", 1, 40).alias("title"), "reviews_count")
