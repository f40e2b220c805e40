"""Share of negative reviews per product and time window, kept up to date by a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from shelfsight.functions.reviews import NEGATIVE
from shelfsight.staging import delete


def negative_windows(
    stream: DataFrame,
    key: str = "asin",
    time: str = "scraped_at",
    negative: Column | None = None,
    window: str = "7 days",
    slide: str | None = None,
    lateness: str = "1 day",
) -> DataFrame:
    """Rows and negative rows per key and window, and with ``slide`` per overlapping window.

    Seven days that slide by one give, each day, the last seven. Rows later than the watermark are dropped, see
    :func:`late_rows`.
    """
    flag = negative if negative is not None else F.col("sentiment") == NEGATIVE
    return (
        stream.withWatermark(time, lateness)
        .groupBy(F.window(time, window, slide), key)
        .agg(F.count("*").alias("reviews"), F.count_if(flag).alias("negative"))
        .select(F.col("window.start").alias("window_start"), key, "reviews", "negative")
    )


def write_updates(windows: DataFrame, path: str, checkpoint_dir: str) -> StreamingQuery:
    """Write the changed windows of each micro-batch to a folder of its own.

    A repeated micro-batch overwrites its own folder, so nothing is counted twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        windows.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def _folders(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """Complete folders ``name=<number>`` below a path, by number."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*/_SUCCESS")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    parents = [f.getPath().getParent() for f in found]
    return {int(p.getName().partition("=")[2]): p.toString() for p in parents}


def read_updates(spark: SparkSession, path: str) -> DataFrame:
    """All updates below ``path`` that count, merged ones included, with their ``batch_id``."""
    merged, updates = _folders(spark, f"{path}/merged", "upto"), _folders(spark, path, "batch_id")
    upto = max(merged, default=-1)
    chosen = [(upto, merged[upto])] if merged else []
    chosen += [(n, f) for n, f in sorted(updates.items()) if n > upto]
    if not chosen:
        raise FileNotFoundError(f"no updates in {path}")
    # Micro-batches without rows may have folders without a file; the others say what the columns are.
    schema = next(df.schema for df in (_read(spark, f) for _, f in reversed(chosen)) if df is not None)
    numbers = F.create_map(*[F.lit(x) for n, f in chosen for x in (f.rpartition("/")[2], n)])
    rows = spark.read.schema(schema).parquet(*[f for _, f in chosen])
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return rows.withColumn("batch_id", numbers[folder])


def _read(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.parquet(folder)
    except AnalysisException as none:
        if none.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def merge_updates(spark: SparkSession, path: str, key: str = "asin") -> int:
    """Put all updates together as one table with a row per window, and delete the folders it replaces; the last batch in it.

    The merged table counts as soon as it is complete, and with it no folder up to its number does, so a merge that dies
    half-way leaves everything readable. Call it while the query does not run; the next one goes on with new folders.
    """
    last = max([*_folders(spark, path, "batch_id"), *_folders(spark, f"{path}/merged", "upto")], default=-1)
    if last < 0:
        return last
    latest = read_updates(spark, path).groupBy("window_start", key).agg(
        F.max_by(F.struct("reviews", "negative"), "batch_id").alias("_latest")
    ).select("window_start", key, "_latest.*")
    before = {**_folders(spark, f"{path}/merged", "upto")}
    if last not in before:
        latest.write.mode("overwrite").parquet(f"{path}/merged/upto={last}")
    stale = [f for n, f in _folders(spark, path, "batch_id").items() if n <= last] + [f for n, f in before.items() if n < last]
    delete(spark, stale)
    return last


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's recent micro-batches dropped because they came after the watermark.

    A query remembers its last 100 micro-batches (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    return sum(
        state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"]
    )


def current_windows(updates: DataFrame, key: str = "asin") -> DataFrame:
    """The latest update of every window, with its negative rate."""
    latest = F.max_by(F.struct("reviews", "negative"), "batch_id").alias("_latest")
    return (
        updates.groupBy("window_start", key).agg(latest)
        .select("window_start", key, "_latest.*")
        .withColumn("negative_rate", F.col("negative") / F.col("reviews"))
    )


def negative_alerts(windows: DataFrame, threshold: float = 0.2) -> DataFrame:
    return windows.where(F.col("negative_rate") > threshold)
