"""An append-only log of product observations, and its history reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def append_log(df: DataFrame, path: str) -> None:
    """Store one run's products below its date and time; a run that is repeated replaces what it stored."""
    (
        df.withColumn("run_date", F.to_date("scraped_at"))
        .withColumn("run_ts", F.date_format("scraped_at", "yyyy-MM-dd'T'HH-mm-ss.SSSSSS"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "run_ts").parquet(path)
    )


def latest_observations(log: DataFrame, key: str = "asin", columns: Sequence[str] | None = None) -> DataFrame:
    """The newest observation of every product, the largest in column order if several are as new.

    A maximum is combined before the shuffle, so a product with very many observations is no burden.
    """
    kept = [c for c in (columns or log.columns) if c not in (key, "scraped_at", "run_date", "run_ts")]
    newest = F.max(F.struct("scraped_at", *kept)).alias("_newest")
    return log.where(F.col(key).isNotNull()).groupBy(key).agg(newest).select(key, "_newest.*")


def price_changes(log: DataFrame, key: str = "asin") -> DataFrame:
    """Average price of each run beside the one before it.

    Observations are combined per product and run first, so a product has one row per run in the window.
    """
    runs = (
        log.where(F.col(key).isNotNull()).groupBy(key, "scraped_at")
        .agg(F.avg("best_price").alias("best_price"))
    )
    by_run = Window.partitionBy(key).orderBy("scraped_at")
    previous = F.lag("best_price").over(by_run)
    return runs.withColumn("previous_price", previous).withColumn(
        "price_change", F.col("best_price") - F.col("previous_price")
    )


def weekly_trend(log: DataFrame, key: str = "asin") -> DataFrame:
    """Observations, price, rating and negative share per product and week, with the calendar week before.

    A week that follows a gap has nothing before it. Columns the log does not have are left out.
    """
    measures = {
        "best_price": F.avg("best_price").alias("avg_price"),
        "rating": F.avg("rating").alias("avg_rating"),
        "sentiment": (F.avg(F.when(F.col("sentiment") == "Negative", 1.0).otherwise(0.0)) * 100)
        .alias("negative_pct"),
    }
    present = {c: m for c, m in measures.items() if c in log.columns}
    weekly = (
        log.where(F.col(key).isNotNull())
        .groupBy(key, F.date_trunc("week", "scraped_at").alias("week"))
        .agg(F.count("*").alias("observations"), *present.values())
    )
    by_week = Window.partitionBy(key).orderBy("week")
    names = [c for c in weekly.columns if c not in (key, "week")]
    paired = weekly.withColumn("_before", F.lag(F.struct("week", *names)).over(by_week))
    adjacent = F.col("_before.week") == F.col("week") - F.expr("INTERVAL 7 DAYS")
    before = F.when(adjacent, F.col("_before"))
    return paired.withColumns({f"previous_{c}": before[c] for c in names}).drop("_before")
