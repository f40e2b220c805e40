"""Preparing a table for storage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.functions.reviews import instant_literal

_NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)


def stamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Add ``scraped_at``, one constant for the whole run."""
    return df.withColumn("scraped_at", instant_literal(run_ts))


def encode_nested(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, with null fields kept; binary columns as plain text."""
    encoded = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, _NESTED):
            encoded[field.name] = F.to_json(field.name, {"ignoreNullFields": "false"})
        elif isinstance(field.dataType, T.BinaryType):
            encoded[field.name] = F.col(field.name).cast("string")
    return df.withColumns(encoded) if encoded else df
