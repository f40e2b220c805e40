"""Answers of an external analyser that outlive the run that asked for them, within the analyser's quota.

A batch is known by a digest of its content, so it is asked about once, whoever asks again and under whatever number.
What is still unanswered is asked in waves. Each task of a wave commits its own answers when it ends, whether or not the
wave does: a run that dies loses the calls its tasks were in, and the next run asks for those alone.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.operators.ordering import number_rows
from shelfsight.sinks.keyed_table import KeyedTable
from shelfsight.staging import scratch_path, stage

Scorer = Callable[[list[dict]], str]
_ANSWER = "digest string, response string, error string"
_JOURNAL = f"{_ANSWER}, asked_at timestamp"
#: Every task's files count once it has committed them, not when the whole job has.
_BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


@dataclass(frozen=True)
class Quota:
    """Calls allowed per minute and per day (UTC), of all tasks together; None is no limit."""

    per_minute: int | None = None
    per_day: int | None = None


@dataclass
class RateLimit:
    """Lets at most ``rate`` calls pass in any minute."""

    rate: int
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _passed: list[tuple[float, int]] = field(default_factory=list)

    def take(self, n: int) -> None:
        """Wait until ``n`` more calls may be made; ``n`` must not be above ``rate``."""
        while True:
            now = self.clock()
            self._passed = [(at, k) for at, k in self._passed if now - at < 60]
            if sum(k for _, k in self._passed) + n <= self.rate:
                self._passed.append((now, n))
                return
            self.sleep(self._passed[0][0] + 60 - now)


def ask(batches: DataFrame, scorer: Scorer, *keys: str) -> DataFrame:
    """Call ``scorer`` once for each row's ``items``; ``response`` is its text, or ``error`` what it raised."""
    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        def answer(items) -> tuple[str | None, str | None]:
            try:
                return scorer([
                    {"text": i["text"], "rating": None if pd.isna(i["rating"]) else i["rating"]} for i in items
                ]), None
            except Exception as failure:
                return None, f"{type(failure).__name__}: {failure}"

        for frame in frames:
            answers = [answer(i) for i in frame["items"]]
            yield frame[list(keys)].assign(
                response=pd.Series([a for a, _ in answers], dtype=object, index=frame.index),
                error=pd.Series([e for _, e in answers], dtype=object, index=frame.index),
            )

    types = dict(batches.dtypes)
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], "response string", "error string"])
    return batches.select(*keys, "items").mapInPandas(run, schema)


def content_digest(model: str = "") -> Column:
    """The digest of a batch's ``items`` for an analyser; another ``model`` is asked anew."""
    return F.sha2(F.concat(F.lit(f"{model}\n"), F.to_json("items")), 256)


class AnswerStore:
    """Answers below ``path``, by digest. There must be one run at a time.

    ``lanes`` calls are made at a time (default: the cluster's cores) and a task makes ``per_task`` of them one after the
    other before it commits, so a lost task repeats at most so many.
    """

    def __init__(
        self, spark: SparkSession, path: str, quota: Quota = Quota(), lanes: int | None = None, per_task: int = 1,
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc), limit: RateLimit | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.quota = quota
        self.lanes = lanes or spark.sparkContext.defaultParallelism
        self.per_task = per_task
        self.clock = clock
        self.limit = limit or (RateLimit(quota.per_minute) if quota.per_minute else None)
        self._answers = KeyedTable(spark, f"{self.path}/answers", "digest", 64)
        self._requests = KeyedTable(spark, f"{self.path}/requests", "run", 1)

    def answers(self) -> DataFrame:
        """``digest``, ``response`` and ``asked_at`` of every answered batch."""
        known = self._answers.read_if_exists()
        return self.spark.createDataFrame([], "digest string, response string, asked_at timestamp") if known is None else known

    def requests(self) -> DataFrame:
        """``run``, ``day`` and the number of ``calls``, failed ones included."""
        known = self._requests.read_if_exists()
        return self.spark.createDataFrame([], "run string, day date, calls bigint") if known is None else known

    def _journals(self) -> list[str]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/journal")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []

    def _journal(self, run: str) -> DataFrame:
        try:
            return self.spark.read.schema(_JOURNAL).parquet(f"{self.path}/journal/{run}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _JOURNAL)

    def settle(self) -> None:
        """Take the answers of runs into the table. A run that was taken in before, but not deleted, changes nothing."""
        for run in self._journals():
            rows = self._journal(run)
            spent = rows.groupBy(F.to_date("asked_at").alias("day")).agg(F.count("*").alias("calls"))
            self._requests.upsert(spent.select(F.lit(run).alias("run"), "day", "calls"), commit_id=run)
            good = rows.where(F.col("response").isNotNull()).groupBy("digest").agg(
                F.min(F.struct("asked_at", "response")).alias("x")
            )
            self._answers.upsert(good.select("digest", "x.response", "x.asked_at"), commit_id=run)
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/journal/{run}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _allowed(self, wanted: int) -> int:
        if self.quota.per_day is None:
            return wanted
        spent = self.requests().where(F.col("day") == F.lit(self.clock().date())).agg(F.sum("calls")).first()[0] or 0
        return max(0, min(wanted, self.quota.per_day - spent))

    def _pending(self, batches: DataFrame) -> tuple[DataFrame, int]:
        """The distinct digests without an answer, numbered, each with one of its batches; and how many there are."""
        pending = batches.join(self.answers().select("digest"), "digest", "left_anti")
        pending = pending.groupBy("digest").agg(F.min("batch_id").alias("batch_id"))
        numbered = stage(number_rows(pending, ["digest"], "ask"), "pending")
        return numbered, numbered.count()

    def ask(self, batches: DataFrame, scorer: Scorer) -> DataFrame:
        """Ask about the batches (``digest``, ``items``; a stored table) that have no answer yet, as far as the quota goes.

        Returns ``(digest, error)`` of the calls that failed in this run. They are not kept as answers: the next run asks
        again. Those beyond the day's quota are not asked about.
        """
        def items_of(wanted: DataFrame) -> DataFrame:
            chosen = wanted.select("digest", "ask", "wave")
            return batches.join(chosen, "digest").dropDuplicates(["digest"])

        return self.ask_digests(batches.select("digest", F.lit(0).cast("bigint").alias("batch_id")), items_of, scorer)

    def ask_digests(
        self, batches: DataFrame, items_of: Callable[[DataFrame], DataFrame], scorer: Scorer
    ) -> DataFrame:
        """As ``ask`` for batches known by ``digest`` and ``batch_id``; ``items_of`` adds their ``items`` to those to ask."""
        self.settle()
        wave = self.lanes * self.per_task
        if self.limit is not None:
            wave = min(wave, self.limit.rate)
        pending, total = self._pending(batches)
        allowed = self._allowed(total)
        path = scratch_path(self.spark, "asking")
        if allowed:
            chosen = pending.where(F.col("ask") < allowed).withColumn("wave", F.expr(f"ask div {wave}"))
            rows = items_of(chosen).select("digest", "items", "ask", "wave")
            # A wave is bounded, so that one task may write it, and it is one file.
            rows.repartition("wave").write.partitionBy("wave").parquet(path)
        run = uuid.uuid4().hex
        for start in range(0, allowed, wave):
            size = min(wave, allowed - start)
            if self.limit is not None:
                self.limit.take(size)
            # A wave is at most lanes * per_task rows: one task reads them and deals them out evenly.
            rows = self.spark.read.parquet(f"{path}/wave={start // wave}").coalesce(1)
            answered = ask(rows.repartition(-(-size // self.per_task)), scorer, "digest")
            answered.withColumn("asked_at", F.lit(self.clock())).write.mode("append").options(**_BY_TASK).parquet(
                f"{self.path}/journal/{run}"
            )
        failed = stage(self._journal(run).where(F.col("response").isNull()).select("digest", "error"), "failed-calls")
        self.settle()
        return failed
