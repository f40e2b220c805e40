"""Row numbers, per-group caps and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.staging import stage

# monotonically_increasing_id keeps the partition above bit 33 and the row below it.
_ROW_BITS = 33
_BROADCAST_ROWS = 100_000
_TOP_K_TASKS = 10_000

# For groupings that have a handful of keys, each of them large.
FEW_KEYS = 64


def broadcast_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if its known row bound is small; else Spark decides by size."""
    return F.broadcast(df) if max_rows <= _BROADCAST_ROWS else df


def split_position(col: Column) -> tuple[Column, Column]:
    """Partition number and row number within it, from a monotonically increasing id."""
    return F.shiftright(col, _ROW_BITS), col.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the total order ``order``.

    A window without partitions would sort the table in one task. Here the table is range-partitioned
    and sorted in place, each row keeps its place within its partition, and the number of rows in
    earlier partitions is added. The sorted rows are staged, because partition bounds are sampled and
    both passes must see the same ones. The offsets are one row per shuffle partition, whatever the size
    of the table, so they are broadcast.
    """
    place = f"_{name}_place"
    ordered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(place, F.monotonically_increasing_id())
    )
    stored = stage(ordered, "numbered")
    part, row = split_position(F.col(place))
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + row)
        .drop("_part", "_offset", place)
    )


def cap_per_group(
    df: DataFrame,
    key: str | None,
    n: int,
    order: Sequence[str | Column],
    spread: int | None = None,
) -> DataFrame:
    """Keep the first ``n`` rows of every key in ``order``; rows without a key are dropped.

    ``n <= 0`` or no key means no cap. Each map task passes on at most ``n`` rows of a key, so a key
    that holds a large share of all rows reaches its reducer as ``n`` rows for each map task and no more.

    With ``spread > 1`` a first round ranks within ``(key, group of map tasks)`` and a second round ranks
    what is left, which divides that reducer's work by ``spread``. It pays if there are few keys, or if
    ``n`` is large; with very many keys it shuffles most rows twice. The default is to spread only if
    ``n`` is above 50, and widely if it is above 1000, where Spark by default has no map-side limit. The
    group does not influence the result, which depends on ``order`` alone.
    """
    if key is None or n <= 0:
        return df
    spread = spread or _spread_for(n)
    keyed = df.where(F.col(key).isNotNull())
    if spread > 1:
        keyed = keyed.withColumn("_spread", F.spark_partition_id() % spread)
        keyed = _first_rows(keyed, [key, "_spread"], n, order).drop("_spread")
    return _first_rows(keyed, [key], n, order)


def _spread_for(n: int) -> int:
    if n <= 50:
        return 1
    return FEW_KEYS if n <= 1000 else 64 * FEW_KEYS


def _first_rows(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str | Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def top_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in ``order``: a top-k in each task and one merge of ``n`` rows from each.

    Very many input splits share their tasks, without a shuffle, which bounds what the merge receives.
    """
    return df.coalesce(_TOP_K_TASKS).orderBy(*order).limit(n)
