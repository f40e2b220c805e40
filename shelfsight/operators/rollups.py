"""The reports of ``reports.py`` from cubes of the stored tables, which are small whatever the tables' size.

Each gives the columns and rows of the report of the same name over the table itself. Averages are sums over counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions import numbers as N
from shelfsight.functions import reviews as R
from shelfsight.operators import quality as Q
from shelfsight.schema import VERIFIED, resolve
from shelfsight.sinks.rollup import Cube


def _value(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _number(df: DataFrame, name: str) -> Column:
    return N.number(df, name) if name in df.columns else F.lit(None).cast("double")


def _product_dimensions(df: DataFrame) -> dict[str, Column]:
    return {n: _value(df, n) for n in ("search_keyword", "price_tier")}


def _product_measures(df: DataFrame) -> dict[str, tuple[Column, str]]:
    price = _number(df, "best_price" if "best_price" in df.columns else "final_price")
    measures = {
        "min_price": (F.min(price), "min"), "max_price": (F.max(price), "max"),
        "discounted": (F.count_if(_number(df, "discount_percent") > 0), "sum"),
    }
    for name, column in (("price", price), ("rating", _number(df, "rating")), ("discount", _number(df, "discount_percent"))):
        measures |= {f"{name}_sum": (F.sum(column), "sum"), f"{name}_count": (F.count(column), "sum")}
    return measures


def _review_dimensions(df: DataFrame) -> dict[str, Column]:
    verified = resolve(df, VERIFIED)
    return {
        "sentiment": _value(df, "sentiment"), "rating": _number(df, "rating"),
        "is_recent": _value(df, "is_recent", "boolean"),
        "verified": F.col(verified).cast("boolean") if verified else F.lit(None).cast("boolean"),
    }


PRODUCT_CUBE = Cube(_product_dimensions, _product_measures)
#: Ratings are a scale of a few steps, so they are a dimension; everything else about reviews is a number of rows.
REVIEW_CUBE = Cube(_review_dimensions, lambda df: {})


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count"))


def _rows(flag: Column | None = None) -> Column:
    """How many rows of the table there are, or for how many ``flag`` holds."""
    counted = F.sum("rows") if flag is None else F.sum(F.when(flag, F.col("rows")).otherwise(0))
    return F.coalesce(counted, F.lit(0))


def _share(flag: Column) -> Column:
    return F.try_divide(_rows(flag), _rows()) * 100


def _average() -> Column:
    rated = F.when(F.col("rating").isNotNull(), F.col("rows"))
    return F.try_divide(F.sum(F.col("rating") * F.col("rows")), F.sum(rated))


# Products

def product_kpis(cube: DataFrame) -> DataFrame:
    return cube.agg(
        _rows().alias("products"), _mean("price").alias("avg_price"), _mean("rating").alias("avg_rating"),
        _mean("discount").alias("avg_discount"),
    )


def price_stats(cube: DataFrame) -> DataFrame:
    return cube.agg(
        F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"),
        _mean("price").alias("avg_price"), _mean("rating").alias("avg_rating"),
    )


def discounted_count(cube: DataFrame) -> DataFrame:
    return cube.agg(F.coalesce(F.sum("discounted"), F.lit(0)).alias("discounted"))


def value_counts(cube: DataFrame, name: str) -> DataFrame:
    found = cube.where(F.col(name).isNotNull()).groupBy(name).agg(_rows().alias("count"))
    return found.orderBy(F.desc("count"), name)


def distinct_options(cube: DataFrame, names: Sequence[str] = ("search_keyword", "price_tier", "sentiment")) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("option"), F.col(n).alias("value")) for n in names if n in cube.columns])
    return cube.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct().orderBy("option", "value")


# Reviews

def review_kpis(cube: DataFrame) -> DataFrame:
    return cube.agg(
        _rows().alias("reviews"), _average().alias("avg_rating"),
        _share(F.col("sentiment") == R.NEGATIVE).alias("negative_pct"),
        _share(F.col("sentiment") == R.POSITIVE).alias("positive_pct"),
    )


def sentiment_distribution(cube: DataFrame) -> DataFrame:
    total = cube.agg(F.sum("rows")).scalar()
    counts = cube.where(F.col("sentiment").isNotNull()).groupBy("sentiment").agg(_rows().alias("count"))
    return counts.withColumn("pct", F.col("count") / total * 100).orderBy(F.desc("count"), "sentiment")


def rating_distribution(cube: DataFrame) -> DataFrame:
    counts = cube.where(F.col("rating").isNotNull()).groupBy("rating").agg(_rows().alias("count"))
    return counts.withColumn("avg_rating", cube.agg(_average()).scalar()).orderBy(F.desc("rating"))


def analysis_coverage(cube: DataFrame) -> DataFrame:
    known = ~F.col("sentiment").eqNullSafe(F.lit(R.UNKNOWN))
    return cube.agg(_rows().alias("reviews"), _rows(known).alias("analysed"), _share(known).alias("coverage_pct"))


def stored_coverage(cube: DataFrame) -> DataFrame:
    known = F.col("sentiment").isNotNull() & (F.col("sentiment") != R.UNKNOWN)
    return cube.agg(_rows().alias("reviews"), _rows(known).alias("with_sentiment"))


def recent_counts(cube: DataFrame) -> DataFrame:
    return cube.agg(
        _rows(F.col("is_recent")).alias("recent"),
        _rows(F.col("is_recent") & (F.col("sentiment") == R.NEGATIVE)).alias("recent_negative"),
    )


def verified_share(cube: DataFrame) -> DataFrame:
    return cube.agg(_rows(F.col("verified")).alias("verified"), _share(F.col("verified")).alias("verified_pct"))


# Gates

def stored_products(cube: DataFrame) -> list[Q.Expectation]:
    """The gate of the same name over the stored products."""
    return [Q.Expectation("not_empty", _rows(), "min", 1.0)]


def stored_reviews(cube: DataFrame) -> list[Q.Expectation]:
    known = F.col("sentiment").isNotNull() & (F.col("sentiment") != R.UNKNOWN)
    return [Q.Expectation("not_empty", _rows(), "min", 1.0), Q.Expectation("with_sentiment", _rows(known), "report")]
