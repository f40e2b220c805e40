"""Exact distinct counts over any runs, from one bitmap per run and range of key numbers.

Every key gets a number when it is first seen, and keeps it. A run stores which numbers it saw, as bitmaps of 32 768 bits,
built in the tasks that read and merged by a bitwise or. Counting the keys of one run or of many reads bitmaps only,
and neither rows nor keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.operators.ordering import number_rows
from shelfsight.sinks.keyed_table import KeyedTable
from shelfsight.staging import stage

_BITMAPS = "run string, `group` string, bucket bigint, bitmap binary"


class KeyBitmaps:
    """Bitmaps below ``path``. There must be one writer at a time; a run that is repeated replaces its own bitmaps."""

    def __init__(self, spark: SparkSession, path: str, key: str = "asin"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self._numbers = KeyedTable(spark, f"{self.path}/numbers", "key", 64)
        self._bitmaps = KeyedTable(spark, f"{self.path}/bitmaps", "run", 16)

    def _numbered(self, keys: DataFrame) -> DataFrame:
        """``key`` and ``number`` of stored distinct keys; new ones get the numbers that follow the largest."""
        known = self._numbers.read_if_exists()
        if known is None:
            known = self.spark.createDataFrame([], "key string, number bigint")
        largest = known.agg(F.max("number")).first()[0] or 0
        # number_rows stores its rows, so that the same numbers are written and used.
        fresh = stage(number_rows(keys.join(known, "key", "left_anti"), ["key"], "place").select(
            "key", (F.col("place") + largest + 1).alias("number")
        ), "key-numbers")
        if not fresh.isEmpty():
            self._numbers.upsert(fresh)
        return known.join(keys, "key", "left_semi").unionByName(fresh)

    def add(self, df: DataFrame, run: str, group: Column | None = None) -> None:
        """Store which keys ``df`` has, and in which group, such as a sentiment; rows without a key are left out.

        Groups must be few. A null group is one of its own.
        """
        named = (group if group is not None else F.lit("all")).cast("string")
        pairs = df.where(F.col(self.key).isNotNull()).select(F.col(self.key).cast("string").alias("key"), named.alias("group"))
        pairs = stage(pairs.distinct(), "key-groups")
        numbers = self._numbered(pairs.select("key").distinct())
        seen = pairs.join(numbers, "key").groupBy("group", F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
        )
        self._bitmaps.upsert(seen.select(F.lit(run).alias("run"), "group", "bucket", "bitmap"))

    def _read(self, runs: Sequence[str] | None) -> DataFrame:
        found = self._bitmaps.read_if_exists()
        if found is None:
            return self.spark.createDataFrame([], _BITMAPS)
        return found if runs is None else found.where(F.col("run").isin(list(runs)))

    def count(self, runs: Sequence[str] | None = None) -> DataFrame:
        """How many different keys the runs (or all) saw together, as ``products``."""
        merged = self._read(runs).groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        return merged.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("products"))

    def count_by_group(self, runs: Sequence[str] | None = None) -> DataFrame:
        """The same for each group: a key counts in every group it was seen in."""
        merged = self._read(runs).groupBy("group", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        return merged.groupBy("group").agg(F.sum(F.bitmap_count("bitmap")).alias("products"))

    def both(self, one: str, other: str) -> DataFrame:
        """How many keys two runs have in common, as ``products``."""
        merged = self._read((one, other)).groupBy("run", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        # A bucket that only one of the runs has shares no key; an and over one bitmap would be that bitmap.
        shared = merged.groupBy("bucket").agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count("*").alias("n"))
        needed = len({one, other})
        return shared.where(F.col("n") == needed).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("products"))
