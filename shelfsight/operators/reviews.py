"""Selecting reviews and adding sentiment, age and verification."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions import numbers as N
from shelfsight.functions import reviews as R
from shelfsight.operators.ordering import broadcast_bounded, cap_per_group
from shelfsight.schema import REVIEW_DATE, REVIEW_KEY, resolve


def reviews_for(reviews: DataFrame, urls: DataFrame, max_urls: int, key: str = "url") -> DataFrame:
    """Reviews of the products in ``urls``; at most ``max_urls`` of them are expected."""
    wanted = urls.select(key).where(F.col(key).isNotNull())
    return reviews.join(broadcast_bounded(wanted, max_urls), key, "left_semi")


def cap_reviews(
    df: DataFrame, n: int, order: Sequence[str | Column], spread: int | None = None
) -> DataFrame:
    """At most ``n`` reviews for each product, by the first key column that exists."""
    return cap_per_group(df, resolve(df, REVIEW_KEY), n, order, spread)


def with_default_analysis(df: DataFrame) -> DataFrame:
    """The analysis columns before any analysis."""
    empty = F.array().cast("array<string>")
    return df.withColumns({
        "sentiment": F.lit(R.UNKNOWN), "issues": empty, "themes": empty, "ai_summary": F.lit(""),
    })


def analyse_by_rating(df: DataFrame) -> DataFrame:
    """Sentiment from the rating alone, with empty issues, themes and summary."""
    if "rating" in df.columns:
        df = df.withColumn("rating", N.number(df, "rating"))
    df = with_default_analysis(df)
    if "rating" in df.columns:
        df = df.withColumn("sentiment", R.rating_sentiment(F.col("rating")))
    return df.withColumn("analysis_method", F.lit("rating"))


def with_recency(df: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """Add ``review_date``, ``review_age_days`` and ``is_recent`` if there is a date column."""
    source = resolve(df, REVIEW_DATE)
    if source is None:
        return df
    return (
        df.withColumn("review_date", R.instant(df, source))
        .withColumn("review_age_days", R.age_days(as_of, F.col("review_date")))
        .withColumn("is_recent", R.is_recent(F.col("review_age_days"), days))
    )


def recent_negative(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_recent") & (F.col("sentiment") == R.NEGATIVE))


def with_summary(df: DataFrame) -> DataFrame:
    """Reviews that have a summary text."""
    return df.where(F.col("ai_summary").isNotNull() & (F.col("ai_summary") != ""))


def has_analysis(df: DataFrame) -> DataFrame:
    return df.where(F.col("sentiment").isNotNull() & (F.col("sentiment") != R.UNKNOWN))


def scraped_within(df: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Rows scraped after ``as_of`` minus a number of days, with no upper end."""
    since = R.instant_literal(as_of) - F.make_interval(days=F.lit(days))
    return df.where(F.col("scraped_at") > since)
