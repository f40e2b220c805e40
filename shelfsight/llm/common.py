"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.staging import stage

#: White space of the word rule, as a set of characters for ``translate`` and as a regular expression.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a side may have to be sent to every executor.
BROADCAST_ROWS = 200_000
_SALTS = 64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stage_rows(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder with a unique, stable ``_row`` for each row."""
    return stage(df.withColumn("_row", F.monotonically_increasing_id()), label)


def key_text(col: str | Column) -> Column:
    """A join key for a column that may be null: null gives '', a value gives '=' and its text."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string") if isinstance(col, str) else col), F.lit(""))


def spread(df: DataFrame, rows: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One side of a join. A side is sent to every executor only if ``rows``, which bounds what might be sent, are few.

    Left alone, Spark goes by the size of files, where many rows may be packed closely.
    """
    return df if rows <= max_rows else df.hint("merge")


def join_counted(big: DataFrame, small: DataFrame, on: str, salt_by: Column, how: str = "left",
                 max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a stored table of one row per key, whose keys may be very frequent in ``big``.

    ``small`` is counted. Up to ``max_rows`` rows it is broadcast. Beyond that it is repeated once for each
    salt, and ``big`` is dealt out by key and salt, so that a key with a third of all rows reaches many tasks.
    ``salt_by`` must be an expression that gives the same value when a task is repeated.
    """
    if small.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(small), on, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    dealt = big.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(_SALTS)).cast("int"))
    # Spark sizes the repeated rows as if they were there once, so without the hint it may broadcast them all.
    return dealt.join(salted.hint("merge"), [on, "_salt"], how).drop("_salt")


def text_values(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text of a batch; a null text is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]
