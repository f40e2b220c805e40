"""Exact quantiles of numeric columns from sketches and a look at what lies between them.

A KLL sketch tells roughly where a rank lies, so it gives two values with the rank between them. A further scan counts
what is below and lists only what is inside; if that is still too much, it is sketched again instead. So what is
shuffled and sorted does not grow with the table or with its distinct values, and the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch, the part of all ranks to either side of the wanted ones, and the values that may be listed.
SKETCH = 2048
MARGIN = 8 / SKETCH
LISTED = 100_000


@dataclass(frozen=True)
class _Search:
    """The rank ``low`` (and the next one, ``high``, to interpolate) of a column, and the values that hold both."""

    name: str
    probability: float
    total: int
    least: float
    most: float
    expected: float
    margin: float = MARGIN

    @property
    def exact(self) -> float:
        return (self.total - 1) * self.probability

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.exact), math.ceil(self.exact)

    def holds(self, below: int, inside: int) -> bool:
        return below <= self.ranks[0] and self.ranks[1] < below + inside


def _grid(margin: float) -> list[float]:
    """Ranks from 0 to 1 in steps of a margin."""
    steps = math.ceil(1 / margin)
    return [min(1.0, i * margin) for i in range(steps + 1)]


def _values_at(sketch: Column, known: Column, margin: float) -> Column:
    """The values at all ranks of the grid; null for a sketch of nothing."""
    ranks = F.array(*[F.lit(r) for r in _grid(margin)])
    return F.when(known > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def _around(values: Sequence[float], inside: int, low: int, high: int, margin: float) -> tuple[float, float]:
    """Two values of the grid between which the ranks ``low`` and ``high`` of ``inside`` values very probably lie."""
    first = math.floor(low / inside / margin) - 1
    last = math.ceil((high + 1) / inside / margin) + 1
    return values[max(0, first)], values[min(len(values) - 1, last)]


def summaries(values: DataFrame, probabilities: Sequence[float]) -> tuple[dict[str, dict], list[_Search]]:
    """Count, mean, deviation and extremes of each column of doubles, and where to look for its quantiles; one scan."""
    names = values.columns
    numbers = []
    for i, n in enumerate(names):
        x = F.col(f"`{n}`")
        numbers += [
            F.count(x).alias(f"count{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"), F.kll_sketch_agg_double(x, F.lit(SKETCH)).alias(f"sketch{i}"),
        ]
    grids = {f"sketch{i}": _values_at(F.col(f"sketch{i}"), F.col(f"count{i}"), MARGIN) for i in range(len(names))}
    row = values.agg(*numbers).withColumns(grids).first()
    stats, searches = {}, []
    for i, n in enumerate(names):
        total = row[f"count{i}"]
        if not total:
            continue
        stats[n] = {"count": total, **{k: row[f"{k}{i}"] for k in ("mean", "std", "min", "max")}}
        for p in probabilities:
            search = _Search(n, p, total, row[f"min{i}"], row[f"max{i}"], total)
            if total > LISTED:
                least, most = _around(row[f"sketch{i}"], total, *search.ranks, MARGIN)
                search = replace(search, least=least, most=most, expected=total * 4 * MARGIN)
            searches.append(search)
    return stats, searches


def _narrowed(values: DataFrame, searches: Sequence[_Search]) -> list[_Search]:
    """The searches after one more scan that counts what is below and inside, and sketches what is inside."""
    numbers, grids = [], {}
    for i, s in enumerate(searches):
        x = F.col(f"`{s.name}`")
        inside = x.between(s.least, s.most)
        numbers += [
            F.count_if(x < s.least).alias(f"below{i}"), F.count_if(inside).alias(f"inside{i}"),
            F.kll_sketch_agg_double(F.when(inside, x), F.lit(SKETCH)).alias(f"sketch{i}"),
        ]
        grids[f"sketch{i}"] = _values_at(F.col(f"sketch{i}"), F.col(f"inside{i}"), s.margin)
    row = values.agg(*numbers).withColumns(grids).first()
    result = []
    for i, s in enumerate(searches):
        below, inside = row[f"below{i}"], row[f"inside{i}"]
        if not s.holds(below, inside):
            # The sketch was off by more than the margin, which it may be once in a while: start again, more widely.
            result.append(_widened(s))
        elif inside <= LISTED or s.least == s.most:
            result.append(replace(s, expected=0))
        else:
            low, high = (r - below for r in s.ranks)
            least, most = _around(row[f"sketch{i}"], inside, low, high, s.margin)
            result.append(replace(s, least=least, most=most, expected=inside * 4 * s.margin))
    return result


def _widened(s: _Search) -> _Search:
    return replace(s, least=-math.inf, most=math.inf, expected=s.total, margin=min(0.1, 2 * s.margin))


def _listed(values: DataFrame, searches: Sequence[_Search]) -> dict[int, list[float] | None]:
    """The values at the two ranks of each search, or None where they are not inside; one scan.

    What is inside is counted by value, and what is below as one more value, all combined in the tasks that read.
    """
    entries = []
    for i, s in enumerate(searches):
        x = F.col(f"`{s.name}`")
        value = F.when(x >= s.least, x)
        entries.append(F.when(x <= s.most, F.struct(F.lit(i).alias("search"), value.alias("value"))))
    pairs = values.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    counts = pairs.groupBy("search", "value").agg(F.count("*").alias("n"))
    upto = F.expr("sum(n) OVER (PARTITION BY search ORDER BY value NULLS FIRST)")
    rank = F.element_at(F.array(*[F.array(*[F.lit(r) for r in s.ranks]) for s in searches]), F.col("search") + 1)
    placed = counts.withColumn("upto", upto).withColumn("rank", F.explode(rank))
    hit = placed.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    found: dict[int, list[float] | None] = {}
    for row in hit.where("value IS NOT NULL").groupBy("search").agg(
        F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("hits")
    ).collect():
        hits = [h["value"] for h in row["hits"]]
        found[row["search"]] = hits if len(hits) == 2 else None
    return found


def sketched_quantiles(values: DataFrame, searches: Sequence[_Search]) -> dict[tuple[str, float], float]:
    """The linearly interpolated quantile for each column and probability of ``searches``."""
    result, left = {}, list(searches)
    while left:
        while any(s.expected > LISTED for s in left):
            left = _narrowed(values, left)
        found = _listed(values, left)
        missed = []
        for i, s in enumerate(left):
            hits = found.get(i)
            if hits is None:
                missed.append(_widened(s))
            else:
                low, high = hits
                result[s.name, s.probability] = low if low == high else low + (high - low) * (s.exact - s.ranks[0])
        left = missed
    return result
