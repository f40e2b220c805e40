"""Incremental ingestion of new snapshot files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from shelfsight.sinks.keyed_table import KeyedTable

RUN = "ingest_run"


def incremental_ingest(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    table: KeyedTable,
    checkpoint_dir: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    run: Column | None = None,
    max_files: int = 1000,
    source_format: str = "json",
    name_filter: str | None = None,
) -> StreamingQuery:
    """Upsert every new file of a folder once, then stop; later runs continue from the checkpoint.

    The unit of replacement is the run: a key has the rows of its latest run, wherever they are among the files.
    ``run`` gives the run of a row, in the order of the runs, and may use ``_metadata``; by default it is the folder
    of the row's file. It is stored as ``ingest_run``. ``max_files`` only paces the work.

    A batch is committed under the name of the checkpoint and its number, so one that is repeated after
    a failure is written once.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert_runs(transform(batch), RUN, commit_id=f"{checkpoint_dir}#{batch_id}")

    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    return (
        reader.format(source_format).load(source_dir)
        .withColumn(RUN, folder if run is None else run)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
