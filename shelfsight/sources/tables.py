"""Stored tables, CSV backups, and the choice between them."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.schema import classify_schema
from shelfsight.sinks.keyed_table import KeyedTable

Pair = tuple[DataFrame | None, DataFrame | None]


def scan_table(table: KeyedTable) -> DataFrame | None:
    """A stored table, or None if there is none."""
    return table.read_if_exists()


def newest_first(df: DataFrame) -> DataFrame:
    """Presentation order of a stored table; leave it out where the rows are only aggregated."""
    return df.orderBy(F.desc("scraped_at"))


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """A database table; with a partition column and bounds it is read by many connections."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column and bounds and partitions:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=str(partitions),
        )
    return reader.load()


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One CSV backup; fields may hold line breaks and quotes. Without a schema, types cost a second scan."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def _listing(spark: SparkSession, folder: str) -> list[str]:
    """Names ending in ``.csv`` directly below a folder, newest name first."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    names = [s.getPath().toString() for s in files.listStatus(root)]
    return sorted((n for n in names if n.endswith(".csv")), reverse=True)


_BACKUP_NAME = re.compile(r"([^/]*?)(?:_\d{8}_\d{6})?\.csv$")


def scan_csv_latest(
    spark: SparkSession, folder: str, schemas: dict[str, T.StructType] | None = None
) -> Pair:
    """The newest product backup and the newest review backup; unreadable ones are passed over.

    The kind of a backup is told from its header alone, and of the backups of one table name only the newest
    readable one is opened. ``schemas`` may name the columns' types by kind, which saves a scan to infer them.
    """
    chosen: dict[str, str] = {}
    seen: set[str] = set()
    for path in _listing(spark, folder):
        table = _BACKUP_NAME.search(path)[1]
        if table in seen:
            continue
        try:
            header = spark.read.option("header", True).csv(path)
        except AnalysisException:
            continue
        if header.columns:
            seen.add(table)
            chosen.setdefault(classify_schema(header), path)
        if len(chosen) == 2:
            break
    found = {kind: scan_csv(spark, path, (schemas or {}).get(kind)) for kind, path in chosen.items()}
    return found.get("products"), found.get("reviews")


def _try_scan(table: KeyedTable) -> DataFrame | None:
    try:
        return scan_table(table)
    except Exception:
        return None


def load_best_source(
    spark: SparkSession, products: KeyedTable, reviews: KeyedTable, backup_dir: str
) -> tuple[DataFrame | None, DataFrame | None, str | None]:
    """Stored tables if either has rows, else CSV backups, else nothing; with a source label."""
    stored = (_try_scan(products), _try_scan(reviews))
    if any(df is not None and not df.isEmpty() for df in stored):
        return (*stored, "Tables")
    backups = scan_csv_latest(spark, backup_dir)
    if any(df is not None for df in backups):
        return (*backups, "CSV Files")
    return None, None, None
