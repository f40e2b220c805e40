"""The most frequent values without a shuffle of all distinct ones, and a proof that they are right.

A frequent-items sketch, merged from all tasks, names candidates, and a second scan counts just these. A value that is not
a candidate has an upper bound: what the sketch says of its last candidate, or twice the sketch's error. If the last
of the wanted values is above it, no other value can be among them; if not, all values are counted after all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values a sketch keeps count of. Its tables are sized in powers of two and filled to three quarters, and the error of a
#: count is at most 3.5 times the number of rows over their size.
TRACKED = 10_000
_FILL, _ERROR = 0.75, 3.5


def _error(rows: int, tracked: int) -> float:
    size = 2 ** math.ceil(math.log2(math.ceil(tracked / _FILL)))
    return _ERROR * rows / size


def _first(items: DataFrame, k: int) -> DataFrame:
    counted = items.groupBy("item").agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "item").limit(k)


def candidates(items: DataFrame, k: int, tracked: int) -> tuple[list, float]:
    """Values that may be among the ``k`` most frequent ones, and a count that no other value is above."""
    wanted = min(tracked, 2 * k + 100)
    named = F.call_function("approx_top_k", F.col("item"), F.lit(wanted), F.lit(tracked))
    row = items.where(F.col("item").isNotNull()).agg(F.count("*").alias("rows"), named.alias("top")).first()
    listed = row["top"] or []
    last = listed[-1]["count"] if len(listed) == wanted else 0
    return [x["item"] for x in listed], max(last, 2 * _error(row["rows"], tracked))


def frequent(df: DataFrame, value: Column, k: int, tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent values of ``value`` as ``item`` and ``count``, the smaller of equally frequent ones first.

    A null value counts like any other. No rows, no items.
    """
    items = df.select(value.alias("item"))
    named, bound = candidates(items, k, tracked)
    if not named:
        return _first(items, k)
    # At most ``k`` rows come to the driver; each task counts the candidates before anything is shuffled.
    found = _first(items.where(F.col("item").isin(named) | F.col("item").isNull()), k).collect()
    if len(found) < k or found[-1]["count"] <= bound:
        return _first(items, k)
    schema = items.schema.add("count", T.LongType())
    return df.sparkSession.createDataFrame([tuple(r) for r in found], schema).orderBy(F.desc("count"), "item")
