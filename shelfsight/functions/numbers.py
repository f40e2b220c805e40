"""Numeric coercion, binning and rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.schema import is_numeric

INF = float("inf")

# Band edges and labels. Every band excludes its lower edge and includes its upper one.
PRICE_EDGES = (0.0, 25.0, 50.0, 100.0, 250.0, INF)
PRICE_LABELS = (
    "Budget (<$25)", "Mid ($25-50)", "Premium ($50-100)", "High-end ($100-250)", "Luxury ($250+)",
)
RATING_EDGES = (0.0, 3.0, 4.0, 4.5, 5.0)
RATING_LABELS = ("Low (<3)", "Average (3-4)", "Good (4-4.5)", "Excellent (4.5-5)")
POPULARITY_EDGES = (0.0, 100.0, 500.0, 1000.0, 5000.0, INF)
POPULARITY_LABELS = (
    "New (<100)", "Growing (100-500)", "Popular (500-1K)", "Very Popular (1K-5K)", "Best Seller (5K+)",
)


def nan_to_null(col: Column) -> Column:
    """NaN means "missing" in the source data; Spark aggregates only skip null."""
    return F.nanvl(col, F.lit(None).cast("double"))


def to_number(col: Column) -> Column:
    """Text to double; anything unparseable, and NaN, becomes null."""
    text = F.trim(col.cast("string"))
    # A trailing type letter ("1d", "2f") parses in the JVM but is not a number in the data.
    tail = F.lower(F.substring(text, -3, 3))
    suffixed = (tail.endswith("d") | tail.endswith("f")) & (tail != "inf")
    return nan_to_null(F.when(~suffixed, text.try_cast("double")))


def number(df: DataFrame, name: str) -> Column:
    """A column of ``df`` as double, parsing text only where it is stored as text."""
    if is_numeric(df, name):
        return nan_to_null(F.col(name).cast("double"))
    return to_number(F.col(name))


def bin_right_closed(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the band ``(edges[i], edges[i + 1]]`` that holds the value, else null."""
    band = F.when(col <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        band = band.when(col <= upper, label)
    return band


def round_half_even(col: Column, digits: int = 1) -> Column:
    """Round half to even, unlike ``round`` which rounds half up."""
    scale = float(10 ** digits)
    return F.rint(col * scale) / scale


def round_exact(col: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even, as decimal formatting does in most languages.

    The product with the scale is rounded itself, so what looks like a tie may lie above or below one.
    The sign of that rounding error decides; splitting the factor in two halves makes it exact.
    """
    scale = float(10 ** digits)
    product = col * scale
    wide = col * 134217729.0  # 2 ** 27 + 1
    high = wide - (wide - col)
    error = (high * scale - product) + (col - high) * scale
    tie = product - F.floor(product) == 0.5
    whole = (
        F.when(tie & (error > 0), F.ceil(product)).when(tie & (error < 0), F.floor(product))
        .otherwise(F.rint(product))
    )
    return F.when(F.abs(product) >= 2.0 ** 52, col).otherwise(whole / scale)


def discount_percent(initial: Column, final: Column) -> Column:
    """Discount in percent of the initial price; unknown is 0 and a zero price gives an infinity."""
    amount = initial - final
    on_zero = (
        F.when(amount < 0, F.lit(-INF)).when(amount > 0, F.lit(INF)).otherwise(F.lit(0.0))
    )
    usual = round_half_even(amount / F.when(initial != 0, initial) * 100)
    return F.coalesce(nan_to_null(F.when(initial == 0, on_zero).otherwise(usual)), F.lit(0.0))


def price_tier(col: Column) -> Column:
    return bin_right_closed(col, PRICE_EDGES, PRICE_LABELS)


def rating_category(col: Column) -> Column:
    return bin_right_closed(col, RATING_EDGES, RATING_LABELS)


def popularity(col: Column) -> Column:
    return bin_right_closed(col, POPULARITY_EDGES, POPULARITY_LABELS)
