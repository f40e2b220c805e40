"""KPIs, distributions, top lists and display tables.

Every report is one map-side combined aggregation, a per-partition top-k, or a bounded set of rows.
Totals of a grouped report come in as a scalar subquery and not through a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.functions import numbers as N
from shelfsight.functions import reviews as R
from shelfsight.functions import text as X
from shelfsight.operators.frequent import frequent
from shelfsight.operators.ordering import FEW_KEYS, cap_per_group, top_rows
from shelfsight.operators.reviews import scraped_within, with_summary
from shelfsight.schema import (
    PRODUCT_CONTEXT, REVIEW_CONTEXT, REVIEW_DISPLAY, VERIFIED, resolve, select_existing,
)


def _share(flag: Column) -> Column:
    """Percent of all rows for which ``flag`` holds; null counts as not."""
    return F.avg(F.when(flag, 1.0).otherwise(0.0)) * 100


def _mean(df: DataFrame, name: str) -> Column:
    """Average of a column, or null if there is none."""
    return F.avg(N.number(df, name)) if name in df.columns else F.lit(None).cast("double")


# Products

def product_kpis(df: DataFrame) -> DataFrame:
    """Rows, average price, average rating and average discount."""
    price = "best_price" if "best_price" in df.columns else "final_price"
    return df.agg(
        F.count("*").alias("products"),
        _mean(df, price).alias("avg_price"),
        _mean(df, "rating").alias("avg_rating"),
        _mean(df, "discount_percent").alias("avg_discount"),
    )


def product_kpi_labels(kpis: DataFrame) -> DataFrame:
    """The KPIs with their display texts beside the numbers."""
    return kpis.withColumns({
        "avg_price_text": X.format_price(F.col("avg_price")),
        "avg_rating_text": X.format_rating(F.col("avg_rating")),
        "avg_discount_text": X.format_percent(F.col("avg_discount")),
    })


def price_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("best_price").alias("min_price"),
        F.max("best_price").alias("max_price"),
        F.avg("best_price").alias("avg_price"),
        F.avg("rating").alias("avg_rating"),
    )


def discounted_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("discount_percent") > 0).alias("discounted"))


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Counts of the non-null values of a column, most frequent first."""
    return (
        df.where(F.col(name).isNotNull())
        .groupBy(name).agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), name)
    )


def count_by_keyword(df: DataFrame) -> DataFrame:
    return value_counts(df, "search_keyword")


def price_tier_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "price_tier")


def distinct_options(
    df: DataFrame, names: Sequence[str] = ("search_keyword", "price_tier", "sentiment")
) -> DataFrame:
    """Sorted distinct values of the filter columns, all from one scan."""
    present = [n for n in names if n in df.columns]
    pairs = F.array(*[F.struct(F.lit(n).alias("option"), F.col(n).alias("value")) for n in present])
    return (
        df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct().orderBy("option", "value")
    )


# Reviews

def review_kpis(df: DataFrame) -> DataFrame:
    """Rows, average rating and the shares of negative and positive reviews."""
    return df.agg(
        F.count("*").alias("reviews"),
        _mean(df, "rating").alias("avg_rating"),
        _share(F.col("sentiment") == R.NEGATIVE).alias("negative_pct"),
        _share(F.col("sentiment") == R.POSITIVE).alias("positive_pct"),
    )


def review_kpi_labels(kpis: DataFrame) -> DataFrame:
    """The KPIs with their display texts beside the numbers."""
    return kpis.withColumns({
        "avg_rating_text": X.format_rating(F.col("avg_rating")),
        "negative_text": X.format_percent(F.col("negative_pct")),
        "positive_text": X.format_percent(F.col("positive_pct")),
    })


def sentiment_distribution(df: DataFrame) -> DataFrame:
    """Counts per sentiment and their percentage of all rows."""
    counts = df.groupBy("sentiment").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return (
        counts.withColumn("pct", F.col("count") / total * 100)
        .where(F.col("sentiment").isNotNull())
        .orderBy(F.desc("count"), "sentiment")
    )


def rating_distribution(df: DataFrame) -> DataFrame:
    """Counts per rating, best first, beside the average over all rated rows."""
    rated = df.select(N.number(df, "rating").alias("rating")).where(F.col("rating").isNotNull())
    counts = rated.groupBy("rating").agg(F.count("*").alias("count"))
    average = counts.agg(F.sum(F.col("rating") * F.col("count")) / F.sum("count")).scalar()
    return counts.withColumn("avg_rating", average).orderBy(F.desc("rating"))


def list_column(df: DataFrame, name: str) -> Column:
    """A list column as an array, parsing it where it is stored as text."""
    return F.col(name) if isinstance(df.schema[name].dataType, T.ArrayType) else X.parse_list(F.col(name))


def top_items(df: DataFrame, name: str, k: int) -> DataFrame:
    """The ``k`` most frequent items of a list column."""
    items = df.select(F.explode(list_column(df, name)).alias("item"))
    return (
        items.groupBy("item").agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "item").limit(k)
    )


def frequent_items(df: DataFrame, name: str, k: int) -> DataFrame:
    """The rows of ``top_items``, for columns with very many different items: two scans in place of a shuffle of them all."""
    return frequent(df.select(F.explode(list_column(df, name)).alias("item")), F.col("item"), k)


def top_issues(df: DataFrame, k: int = 10) -> DataFrame:
    return top_items(df, "issues", k)


def top_themes(df: DataFrame, k: int = 15) -> DataFrame:
    return top_items(df, "themes", k)


def first_issues(df: DataFrame, order: Sequence[str | Column], k: int = 10) -> DataFrame:
    """The first ``k`` issues in row order, unranked and with repeats, numbered from 1."""
    placed = [*order, "_pos"]
    items = df.select("*", F.posexplode(list_column(df, "issues")).alias("_pos", "issue"))
    first = top_rows(items, k, placed)
    # The window sees the k rows that are left.
    return first.select(F.row_number().over(Window.orderBy(*placed)).alias("place"), "issue")


def review_summary(
    df: DataFrame, order: Sequence[str | Column], models: Sequence[str] = ()
) -> DataFrame:
    """One row of summary metrics for the steps that follow."""
    placed = F.array_sort(F.collect_list(F.struct("place", "issue")))
    issues = first_issues(df, order).agg(
        F.transform(placed, lambda x: x["issue"]).alias("issues")
    ).scalar()
    return df.agg(
        F.count("*").alias("total_reviews"),
        _mean(df, "rating").alias("avg_rating"),
        _share(F.col("sentiment") == R.NEGATIVE).alias("negative_pct"),
    ).withColumns({
        "ai_powered": F.lit(bool(models)),
        "models_used": F.array(*[F.lit(m) for m in models]).cast("array<string>"),
        "top_issues": issues,
    })


def analysis_coverage(df: DataFrame) -> DataFrame:
    """Share of rows whose sentiment is not ``Unknown``; null sentiment counts as analysed."""
    known = ~F.col("sentiment").eqNullSafe(F.lit(R.UNKNOWN))
    return df.agg(
        F.count("*").alias("reviews"), F.count_if(known).alias("analysed"),
        _share(known).alias("coverage_pct"),
    )


def stored_coverage(df: DataFrame) -> DataFrame:
    """Stored rows, and those with a sentiment that is neither null nor ``Unknown``."""
    known = F.col("sentiment").isNotNull() & (F.col("sentiment") != R.UNKNOWN)
    return df.agg(F.count("*").alias("reviews"), F.count_if(known).alias("with_sentiment"))


def method_counters(df: DataFrame) -> DataFrame:
    """Reviews by the way their sentiment was found, and how many of them after an error of their scorer."""
    failed = [F.count("analysis_error").alias("errors")] if "analysis_error" in df.columns else []
    return df.groupBy("analysis_method").agg(F.count("*").alias("count"), *failed).orderBy("analysis_method")


def recent_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("is_recent")).alias("recent"),
        F.count_if(F.col("is_recent") & (F.col("sentiment") == R.NEGATIVE)).alias("recent_negative"),
    )


def verified_share(df: DataFrame) -> DataFrame:
    """Verified purchases and their percentage of all rows."""
    flag = F.col(resolve(df, VERIFIED)).cast("boolean")
    return df.agg(F.count_if(flag).alias("verified"), _share(flag).alias("verified_pct"))


def products_covered(df: DataFrame) -> DataFrame:
    key = resolve(df, ("asin", "product_asin"))
    return df.agg(F.countDistinct(key).alias("products"))


def negative_rate(
    df: DataFrame,
    as_of: datetime,
    keys: Sequence[str] = ("asin", "product_name"),
    days: int = 7,
    threshold: float = 0.2,
) -> DataFrame:
    """Products whose share of negative reviews in the last days is above ``threshold``."""
    negative = F.when(F.col("sentiment") == R.NEGATIVE, 1.0).otherwise(0.0)
    return (
        scraped_within(df, as_of, days)
        .groupBy(*keys).agg(F.avg(negative).alias("negative_rate"), F.count("*").alias("reviews"))
        .where(F.col("negative_rate") > threshold)
    )


def summaries_by_sentiment(
    df: DataFrame, order: Sequence[str | Column], per_sentiment: int = 10
) -> DataFrame:
    """For each sentiment but ``Unknown``: how many summaries there are, and the first of them.

    The first rows of all sentiments come from one scan, capped in each map task, and the sizes are a narrow
    aggregation. Counting with a window would bring all rows of one sentiment into one task.
    """
    shown = (R.NEGATIVE, R.NEUTRAL, R.POSITIVE)
    rows = with_summary(df).where(F.col("sentiment").isin(*shown))
    sizes = rows.groupBy("sentiment").agg(F.count("*").alias("group_size"))
    first = cap_per_group(rows, "sentiment", per_sentiment, order, FEW_KEYS)
    rating = F.col("rating") if "rating" in df.columns else F.lit(None).cast("double")
    issues = list_column(df, "issues") if "issues" in df.columns else F.array().cast("array<string>")
    line = X.summary_line(rating, F.col("ai_summary"), issues)
    # One row per sentiment: at most three.
    return first.withColumn("line", line).join(F.broadcast(sizes), "sentiment")


def review_table(df: DataFrame, order: Sequence[str | Column], n: int = 100) -> DataFrame:
    """The display columns of the newest reviews."""
    return select_existing(top_rows(df, n, order), REVIEW_DISPLAY)


def product_sample(df: DataFrame, order: Sequence[str | Column], n: int = 20) -> DataFrame:
    return select_existing(top_rows(df, n, order), PRODUCT_CONTEXT)


def review_sample(df: DataFrame, order: Sequence[str | Column], n: int = 25) -> DataFrame:
    """The first reviews that have a summary."""
    return select_existing(top_rows(with_summary(df), n, order), REVIEW_CONTEXT)
