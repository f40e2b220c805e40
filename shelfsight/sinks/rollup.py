"""Partial aggregates that follow a keyed table, so that reports read them and not the table.

A file of a keyed table never changes; an upsert adds files and drops others. So each file's rows are aggregated once,
when it appears, and its partial rows go when it goes: what an upsert replaces is taken back and what it writes is
added, at the cost of reading the files it wrote. A report sums the partial rows of the current files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.sinks.keyed_table import KeyedTable

_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Cube:
    """What to group by, and what to aggregate.

    ``dimensions`` and ``measures`` give the columns for a table; a measure is an aggregate and how two of its values
    become one: ``sum``, ``min`` or ``max``. The number of rows is always there, as ``rows``. Dimensions must have few
    values.
    """

    dimensions: Callable[[DataFrame], Mapping[str, Column]]
    measures: Callable[[DataFrame], Mapping[str, tuple[Column, str]]]

    def of(self, rows: DataFrame, *keys: str) -> DataFrame:
        """The aggregates of each combination of dimensions, and of ``keys`` before them."""
        groups = [c.alias(n) for n, c in self.dimensions(rows).items()]
        values = [c.alias(n) for n, (c, _) in self.measures(rows).items()]
        return rows.groupBy(*keys, *groups).agg(F.count("*").alias("rows"), *values)

    def merged(self, partial: DataFrame, template: DataFrame) -> DataFrame:
        """Partial aggregates of a table like ``template`` put together."""
        values = [_MERGE[how](n).alias(n) for n, (_, how) in self.measures(template).items()]
        return partial.groupBy(*self.dimensions(template)).agg(F.sum("rows").alias("rows"), *values)


class RolledTable:
    """A keyed table with a cube beside it."""

    def __init__(self, spark: SparkSession, path: str, key: str | None, cube: Cube, buckets: int = 256):
        self.spark = spark
        self.cube = cube
        self.table = KeyedTable(spark, path, key, buckets)
        self._partials = KeyedTable(spark, f"{path.rstrip('/')}/rollup", None, 1)

    def read(self) -> DataFrame:
        return self.table.read()

    def upsert(self, batch: DataFrame, commit_id: str | None = None) -> None:
        """Upsert the batch, then bring the cube up to date."""
        self.table.upsert(batch, commit_id)
        self.refresh()

    def replace_all(self, df: DataFrame, commit_id: str | None = None) -> None:
        self.table.replace_all(df, commit_id)
        self.refresh()

    def refresh(self) -> None:
        """Aggregate the files that have no partial rows, and drop those of files that are gone.

        It depends on the table's state alone: after a run that died between table and cube, the next one catches up.
        """
        parts, schema = self.table.parts()
        known, kept = set(), None
        old = self._partials.read_if_exists()
        if old is not None:
            known = {r["part"] for r in old.select("part").distinct().collect()}
            kept = old.join(self._names(parts), "part", "left_semi")
        new = [p for p in parts if p not in known]
        if not new and known <= set(parts):
            return
        fresh = self.cube.of(self.table.read_parts(new, schema), "part")
        # Columns that the table got since are null in older partial rows; a changed cube would need a rebuild.
        self._partials.replace_all(fresh if kept is None else fresh.unionByName(kept, allowMissingColumns=True))

    def _names(self, parts: list[str]) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame([(p,) for p in parts], "part string"))

    def totals(self) -> DataFrame:
        """The cube of all current rows, read from partial rows only."""
        parts, schema = self.table.parts()
        template = self.spark.createDataFrame([], schema)
        if not parts:
            return self.cube.of(template)
        current = self._partials.read().join(self._names(parts), "part", "left_semi")
        return self.cube.merged(current, template)
