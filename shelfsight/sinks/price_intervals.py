"""Prices as intervals of runs in which they did not change.

A log of observations grows by every product in every run. Here a run adds rows only for what changed: an interval ends
where a product's price changes or a run does not see it, and a new one begins. The open intervals, one per product,
are written anew in each run, and the closed ones of each run are never touched again.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_RUNS = "run int, micros bigint"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _micros(moment: datetime) -> int:
    """Microseconds since 1970; a time without a zone is local, as in a Spark literal."""
    return (moment.astimezone(timezone.utc) - _EPOCH) // timedelta(microseconds=1)


class PriceIntervals:
    """Intervals below ``path``: ``key``, ``price``, ``first_run``, ``last_run`` (run numbers from 1), and the last price before.

    Runs come in time order. The last run may be repeated and then replaces itself; there must be one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "asin", price: str = "best_price"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.price = price

    def _files(self):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def runs(self) -> list[tuple[int, int]]:
        """Numbers and times, in microseconds, of the runs so far. A run counts when its small file is there, which is written last."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/runs")
        if not self._files().exists(folder):
            return []
        rows = self.spark.read.schema(_RUNS).json(f"{self.path}/runs").distinct().collect()
        return sorted((r["run"], r["micros"]) for r in rows)

    def _times(self) -> Column:
        """The time of each run, by number: one entry per run, whatever the number of products."""
        return F.create_map(*[x for n, t in self.runs() for x in (F.lit(n), F.timestamp_micros(F.lit(t)))])

    def _kind(self, df: DataFrame) -> str:
        return dict(df.dtypes)[self.key]

    def _open(self, run: int, kind: str) -> DataFrame:
        """The intervals that were open after a run."""
        schema = f"`{self.key}` {kind}, price double, first_run int, last_run int, previous_price double, known boolean"
        if run == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/open/run={run}")

    def append(self, df: DataFrame, run_ts: datetime) -> None:
        """Add a run: the average price of each of its products, which may be null. Rows without a key are left out."""
        known, now = self.runs(), _micros(run_ts)
        last = known[-1] if known else (0, now - 1)
        if now < last[1]:
            raise ValueError(f"the run of {run_ts} is before the last one")
        run = last[0] if now == last[1] else last[0] + 1
        seen = df.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.avg(self.price).alias("now"))
        before = self._open(run - 1, self._kind(df))
        both = before.join(seen.withColumn("seen", F.lit(True)), self.key, "full")
        unbroken = F.col("last_run") == run - 1
        same = F.col("seen").isNotNull() & unbroken & F.col("price").eqNullSafe(F.col("now"))
        opened = F.col("seen").isNotNull() & ~F.coalesce(same, F.lit(False))
        # A product that was seen before keeps its last price for the next interval, whether or not it changed.
        both = both.withColumns({"same": F.coalesce(same, F.lit(False)), "opened": opened})
        state = both.select(
            self.key,
            F.when(F.col("opened"), F.col("now")).otherwise(F.col("price")).alias("price"),
            F.when(F.col("opened"), F.lit(run)).otherwise(F.col("first_run")).alias("first_run"),
            F.when(F.col("seen").isNotNull(), F.lit(run)).otherwise(F.col("last_run")).alias("last_run"),
            F.when(F.col("opened"), F.col("price")).otherwise(F.col("previous_price")).alias("previous_price"),
            F.when(F.col("opened"), F.col("first_run").isNotNull()).otherwise(F.col("known")).alias("known"),
        )
        closed = both.where("opened AND first_run IS NOT NULL").select(
            self.key, "price", "first_run", "last_run", "previous_price", "known"
        )
        closed.write.mode("overwrite").parquet(f"{self.path}/closed/run={run}")
        state.write.mode("overwrite").parquet(f"{self.path}/open/run={run}")
        mark = self.spark.range(1, numPartitions=1).select(F.lit(run).alias("run"), F.lit(now).alias("micros"))
        mark.write.mode("overwrite").json(f"{self.path}/runs/at={run}")
        # The state before this run stays, so that the run can be repeated; the one before that is not needed again.
        old = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/open/run={run - 2}")
        self._files().delete(old, True)

    def intervals(self) -> DataFrame:
        """All intervals with ``from_ts`` and ``to_ts``, the times of their first and last run, and ``previous_price``."""
        known = self.runs()
        if not known:
            raise FileNotFoundError(f"no run in {self.path}")
        kind = self._kind(self.spark.read.parquet(f"{self.path}/open/run={known[-1][0]}"))
        current = self._open(known[-1][0], kind)
        closed = self.spark.read.schema(current.schema).parquet(*[f"{self.path}/closed/run={n}" for n, _ in known])
        times = self._times()
        return closed.unionByName(current).withColumns({"from_ts": times[F.col("first_run")], "to_ts": times[F.col("last_run")]})

    def changes(self) -> DataFrame:
        """What ``price_changes`` gives for a log of the same runs: each run's price beside the one before it."""
        found = self.intervals()
        at = found.withColumn("run", F.explode(F.sequence("first_run", "last_run")))
        times = self._times()
        previous = F.when(F.col("run") > F.col("first_run"), F.col("price")).otherwise(F.col("previous_price"))
        return at.select(
            self.key, times[F.col("run")].alias("scraped_at"), F.col("price").alias(self.price), previous.alias("previous_price"),
        ).withColumn("price_change", F.col(self.price) - F.col("previous_price"))

    def at(self, moment: datetime) -> DataFrame:
        """The price of each product in the last run up to a moment, as far as that run saw it: narrow, whatever the history."""
        run = max((n for n, t in self.runs() if t <= _micros(moment)), default=0)
        return self.intervals().where((F.col("first_run") <= run) & (F.col("last_run") >= run)).select(self.key, "price")
