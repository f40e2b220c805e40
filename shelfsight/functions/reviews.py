"""Dates and sentiment of a review."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSITIVE, NEUTRAL, NEGATIVE, UNKNOWN = "Positive", "Neutral", "Negative", "Unknown"
SENTIMENTS = (POSITIVE, NEUTRAL, NEGATIVE, UNKNOWN)

DATE_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy", "d MMMM yyyy", "yyyy/M/d")

_DAY_MICROS = 86_400_000_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def rating_sentiment(rating: Column) -> Column:
    """Sentiment by the star rating alone."""
    return (
        F.when(rating.isNull(), UNKNOWN)
        .when(rating >= 4, POSITIVE)
        .when(rating >= 3, NEUTRAL)
        .otherwise(NEGATIVE)
    )


def instant_literal(moment: datetime) -> Column:
    """A fixed instant; a moment without a zone is UTC, whatever the zone of the driver."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit((moment - _EPOCH) // timedelta(microseconds=1)))


def parse_timestamp(col: Column) -> Column:
    """Text to a UTC instant; each row may use its own format, bad text is null."""
    text = F.trim(col)
    tries = [F.try_to_timestamp(text)]
    tries += [F.try_to_timestamp(text, F.lit(fmt)) for fmt in DATE_FORMATS]
    return F.coalesce(*tries)


def instant(df: DataFrame, name: str) -> Column:
    """A column of ``df`` as a UTC instant, parsing text only where it is stored as text."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return parse_timestamp(F.col(name).cast("string"))


def age_days(as_of: datetime, moment: Column) -> Column:
    """Whole days from ``moment`` to ``as_of``, rounded down, so the future is negative."""
    micros = F.unix_micros(instant_literal(as_of)) - F.unix_micros(moment)
    return ((micros - F.pmod(micros, F.lit(_DAY_MICROS))) / F.lit(_DAY_MICROS)).cast("bigint")


def is_recent(age: Column, days: int = 30) -> Column:
    return F.coalesce(age <= days, F.lit(False))
