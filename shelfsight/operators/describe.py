"""Column statistics: counts, most frequent values, moments and exact quartiles.

Numbers take one scan for moments and sketches and a second one for the quartiles, see ``quantiles``. Distinct counts
and modes of texts need equal texts to meet: all text columns become ``(column, text)`` pairs that are counted, so a
frequent text is combined before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions.numbers import number
from shelfsight.operators.ordering import split_position
from shelfsight.operators.quantiles import sketched_quantiles, summaries
from shelfsight.schema import is_numeric
from shelfsight.staging import stage

QUARTILES = (0.25, 0.5, 0.75)
_NUMERIC = "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"


def _counts(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """Stored ``(column, text, n)``: how often each value of the columns occurs, from one scan."""
    entries = [F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("text")) for n in texts]
    pairs = df.select(F.inline(F.array(*entries))).where("text IS NOT NULL")
    return stage(pairs.groupBy("column", "text").agg(F.count("*").alias("n")), "value-counts")


def exact_quantiles(counts: DataFrame, probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """For values that are counted already: linearly interpolated quantiles of ``(column, value, n)`` rows, one row per column and probability.

    The counts are range-partitioned by value. The number of observations in earlier partitions tells
    which partitions hold the wanted ranks, and only those are ranked row by row.
    """
    ordered = (
        counts.repartitionByRange("column", "value")
        .sortWithinPartitions("column", "value")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part, _ = split_position(F.col("_place"))
    stored = stage(ordered, "counts").withColumn("_part", part).drop("_place")

    # One row per column and partition.
    sizes = stored.groupBy("column", "_part").agg(F.sum("n").alias("_size"))
    by_column = Window.partitionBy("column")
    earlier = by_column.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = sizes.select(
        "column", "_part", "_size",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(by_column).alias("_total"),
    )
    wanted = (
        spans.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("_exact", (F.col("_total") - 1) * F.col("probability"))
        .withColumn("_rank", F.explode(F.array_distinct(F.array(
            F.floor("_exact").cast("bigint"), F.ceil("_exact").cast("bigint")
        ))))
        .where(F.col("_rank").between(F.col("_before"), F.col("_before") + F.col("_size") - 1))
    )
    # At most two ranks for each column and probability.
    ranks = F.broadcast(wanted.select("column", "_part", "_before", "probability", "_exact", "_rank"))
    parts = F.broadcast(wanted.select("column", "_part").distinct())
    within = Window.partitionBy("column", "_part").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = stored.join(parts, ["column", "_part"], "left_semi").withColumn("_upto", F.sum("n").over(within))
    hits = placed.join(ranks, ["column", "_part"]).where(
        (F.col("_rank") < F.col("_before") + F.col("_upto"))
        & (F.col("_rank") >= F.col("_before") + F.col("_upto") - F.col("n"))
    )
    low, high = F.min("value"), F.max("value")
    weight = F.max(F.col("_exact") - F.floor("_exact"))
    return hits.groupBy("column", "probability").agg(
        F.when(low == high, low).otherwise(low + (high - low) * weight).alias("quantile")
    )


def _numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row for each column with a value; they are as many as the columns, so they come from the driver."""
    values = df.select(*[number(df, n).alias(n) for n in names])
    stats, searches = summaries(values, QUARTILES)
    quartiles = sketched_quantiles(values, searches)

    def known(x: float | None) -> float | None:
        return None if x is None or math.isnan(x) else x

    rows = [
        (n, s["count"], known(s["mean"]), known(s["std"]), s["min"], *[quartiles[n, p] for p in QUARTILES], s["max"])
        for n, s in stats.items()
    ]
    return df.sparkSession.createDataFrame(rows, _NUMERIC)


def _text(counts: DataFrame) -> DataFrame:
    best = counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"), F.max("n").alias("freq")
    )
    # One row for each described column.
    top = (
        counts.join(F.broadcast(best.select("column", "freq")), "column")
        .where(F.col("n") == F.col("freq"))
        .groupBy("column").agg(F.min("text").alias("top"))
    )
    return best.join(top, "column").select("column", "count", "unique", "top", "freq")


def describe_numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and quartiles of numeric columns."""
    return _numeric(df, names)


def describe_text(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, distinct count and the most frequent value (the smallest on ties) of text columns."""
    return _text(_counts(df, names))


def describe_all(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per column; text statistics are empty for numbers and the other way round."""
    wanted = [n for n in (names or df.columns) if n in df.columns]
    numbers = [n for n in wanted if is_numeric(df, n)]
    texts = [n for n in wanted if n not in numbers]
    parts = ([_text(_counts(df, texts))] if texts else []) + ([_numeric(df, numbers)] if numbers else [])
    result = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    fields = ("column", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max")
    return result.select(*[f for f in fields if f in result.columns])
