"""Alerts that fire once, when the share of negative reviews of a product's last days rises above a threshold.

Reviews are counted per product and day first, which tasks do before the shuffle, so a product with very many reviews
reaches its state as one row for each day. The state holds the counts of the last days. A day is judged when the watermark
has passed it and all its reviews are in, also a day without reviews, because old days drop out of the rate; so the
alerts do not depend on how the stream was cut into micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues,
)

from shelfsight.functions.reviews import NEGATIVE
from shelfsight.session import DEFAULTS

_EPOCH = date(1970, 1, 1)
_DAY_MS = 86_400_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STATE = "judged int, alerting boolean, days array<int>, reviews array<bigint>, negative array<bigint>"


def _rate_crossings(key_name: str, span: int, threshold: float) -> StatefulProcessor:
    """The processor. Its class is made here, so that it travels with the query and workers need not have this package."""
    class RateCrossings(StatefulProcessor):
        """Per product: counts of the last ``span`` days that have any, the last day judged, and whether its rate was above."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("days", _STATE)

        def close(self) -> None:
            pass

        def _load(self) -> tuple[int | None, bool, dict[int, tuple[int, int]]]:
            if not self.state.exists():
                return None, False, {}
            judged, alerting, days, reviews, negative = self.state.get()
            return judged, alerting, {d: (r, n) for d, r, n in zip(days, reviews, negative, strict=True)}

        def _judge(self, day: int, alerting: bool, counts: dict[int, tuple[int, int]]) -> tuple[bool, tuple | None]:
            """Whether the rate is above the threshold at the end of a day, and the alert if it was not before."""
            for old in [d for d in counts if d <= day - span]:
                del counts[old]
            reviews, negative = (sum(c[i] for c in counts.values()) for i in (0, 1))
            above = reviews > 0 and negative > threshold * reviews
            alert = (_EPOCH + timedelta(days=day), negative / reviews, reviews, negative) if above and not alerting else None
            return above, alert

        def _advance(self, rows: list[tuple[int, int, int]], until: int | None) -> list[tuple]:
            """Add the days' counts in order, judge each day on the way, and those up to ``until`` as long as any count."""
            judged, alerting, counts = self._load()
            alerts = []

            def judge_to(day: int) -> None:
                nonlocal judged, alerting
                while judged is not None and judged < day and counts:
                    judged += 1
                    alerting, alert = self._judge(judged, alerting, counts)
                    alerts.extend([alert] if alert else [])

            for day, reviews, negative in sorted(rows):
                judge_to(day - 1)
                before = counts.get(day, (0, 0))
                counts[day] = before[0] + reviews, before[1] + negative
                judged = day - 1 if judged is None or judged < day - 1 else judged
                judge_to(day)
            if until is not None:
                judge_to(until)
            if not counts:
                self.state.clear()
                return alerts
            days = sorted(counts)
            self.state.update((judged, alerting, days, [counts[d][0] for d in days], [counts[d][1] for d in days]))
            # The next day is over when the watermark has passed its end.
            self.handle.registerTimer((judged + 2) * _DAY_MS)
            return alerts

        def _frame(self, key: tuple, alerts: list[tuple]) -> Iterator:
            import pandas as pd

            if alerts:
                yield pd.DataFrame([(*key, *a) for a in alerts], columns=[key_name, "day", "negative_rate", "reviews", "negative"])

        def handleInputRows(self, key: tuple, rows: Iterator, timerValues: TimerValues) -> Iterator:  # noqa: N802
            days = [
                ((day.date() - _EPOCH).days, int(reviews), int(negative))
                for frame in rows
                for day, reviews, negative in zip(frame["day"], frame["reviews"], frame["negative"], strict=True)
            ]
            yield from self._frame(key, self._advance(days, None))

        def handleExpiredTimer(  # noqa: N802
            self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
        ) -> Iterator:
            # The watermark may have passed several days at once; their rows came before this call.
            ended = timerValues.getCurrentWatermarkInMs() // _DAY_MS - 1
            judged, _, _ = self._load()
            if judged is not None and judged < ended:
                yield from self._frame(key, self._advance([], ended))

    return RateCrossings()


def negative_crossings(
    stream: DataFrame,
    key: str = "asin",
    time: str = "scraped_at",
    negative: Column | None = None,
    review_id: str | None = None,
    span: int = 7,
    threshold: float = 0.2,
    lateness: str = "1 day",
) -> DataFrame:
    """Alerts ``(key, day, negative_rate, reviews, negative)`` of days on which the rate of the last ``span`` days crosses.

    A product whose rate stays above the threshold gives no second alert; one that falls and rises again does. With
    ``review_id``, a review that comes again within the watermark counts once. Rows without a key or a time are left
    out, and those later than the watermark are dropped. Days are in the session's time zone, which should be UTC.
    """
    flag = negative if negative is not None else F.col("sentiment") == NEGATIVE
    rows = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, lateness)
    if review_id is not None:
        rows = rows.dropDuplicatesWithinWatermark([review_id])
    daily = rows.groupBy(F.window(time, "1 day"), key).agg(
        F.count("*").alias("reviews"), F.count_if(flag).alias("negative")
    ).select(F.col("window.start").alias("day"), F.window_time("window").alias("day_end"), key, "reviews", "negative")
    kind = dict(daily.dtypes)[key]
    return daily.groupBy(key).transformWithStateInPandas(
        _rate_crossings(key, span, threshold),
        f"`{key}` {kind}, day date, negative_rate double, reviews bigint, negative bigint",
        "append", "eventTime",
    )


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB if the session has Spark's default store, which cannot hold it."""
    before = spark.conf.get(_PROVIDER)
    if before.endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, DEFAULTS[_PROVIDER])
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def write_alerts(alerts: DataFrame, path: str, checkpoint_dir: str) -> StreamingQuery:
    """Write the alerts of each micro-batch to a folder of its own; a repeated micro-batch overwrites its own.

    The session may have any state store: a query keeps the one it was started with.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = (
        alerts.writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True)
    )
    with _state_store(alerts.sparkSession):
        return writer.start()
