"""Exact dedup by a tree of merged digest runs.

Every partition of the input makes a run: its digests in sorted order, each with the best row and a count. In
each round, runs whose numbers agree but for the last bits meet and are merged, until one run is left, itself
spread over many tasks by digest. The answers then go back down the same tree, so a group of copies, however
large, is never dealt to one task: a task of the last step gets the copies of one input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.common import SPACES, stage_rows

#: Runs merged at once, as a power of two.
_FAN_BITS = 6
#: monotonically_increasing_id has the partition above bit 33.
_PARTITION_BIT = 33
#: Rows are the same only if the digest, a second hash and the length all agree.
_SAME = ["_digest", "_check", "_length"]


def squeezed(text: str) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, "")


def _best(key: str) -> Column:
    """Sorts the row to keep first: longest original text, then smallest id (null last), then first row."""
    return F.struct((-F.col("_chars")).alias("chars"), F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("_row").alias("row"))


def exact_groups(rows: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``_row, key, keep_id, keep_row, group_size, kept, _digest`` for each of ``rows``, which have a stable ``_row``.

    Texts are equal if they are identical without white space; null is an empty text. The row with most code
    points stays, then the one with the smallest id (null last), then the first stored one; exactly one row of
    a group stays, also among rows that repeat an id. An empty table gives no rows.
    """
    bare = squeezed(text)
    narrow = stage_rows(
        rows.select(
            key, *([F.col("_row").alias("_input")] if "_row" in rows.columns else []),
            F.unhex(F.sha2(bare, 256)).alias("_digest"), F.xxhash64(bare).alias("_check"),
            F.octet_length(bare).alias("_length"), F.coalesce(F.length(text), F.lit(0)).alias("_chars"),
        ),
        "digests",
    )
    runs = narrow.agg(F.max(F.shiftright("_row", _PARTITION_BIT))).first()[0] or 0
    narrow = narrow.withColumn("_run", F.shiftright("_row", _PARTITION_BIT))
    level = narrow.groupBy("_run", *_SAME).agg(F.min(_best(key)).alias("_first"), F.count("*").alias("_n"))
    levels = [level]
    while runs:
        runs >>= _FAN_BITS
        level = level.groupBy(F.shiftright("_run", _FAN_BITS).alias("_run"), *_SAME).agg(
            F.min("_first").alias("_first"), F.sum("_n").alias("_n")
        )
        levels.append(level)
    answer = levels.pop().select("_run", *_SAME, "_first", "_n")
    while levels:
        above = answer.withColumnRenamed("_run", "_parent")
        below = levels.pop().select("_run", *_SAME, F.shiftright("_run", _FAN_BITS).alias("_parent"))
        answer = below.join(above, ["_parent", *_SAME]).drop("_parent")
    found = narrow.join(answer, ["_run", *_SAME])
    return found.select(
        *(["_input"] if "_row" in rows.columns else []), key, F.col("_first.id").alias("keep_id"),
        F.col("_n").alias("group_size"), (F.col("_first.row") == F.col("_row")).alias("kept"), "_digest",
    )


def exact_dedup(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    See :func:`exact_groups` for nulls, ties and repeated rows. An empty table gives no rows; other columns,
    whatever their names, pass through, but for names that begin with an underscore.
    """
    rows = stage_rows(df, "exact-rows")
    kept = exact_groups(rows.select("_row", text, key), text, key).where("kept").select(F.col("_input").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*df.columns)
