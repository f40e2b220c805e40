"""Written intermediate tables in the cluster's shared checkpoint folder.

A staged table cuts lineage and survives the loss of executors, because its
rows live in the shared folder and not on the machines that computed them.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or the context; a temporary one only in local mode."""
    folder = spark.conf.get(_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {_CONF} to a folder that every executor can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="shelfsight-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the stored rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    for paths in _OPEN:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


_OPEN: list[list[str]] = []


@contextmanager
def staged(paths: list[str]) -> Iterator[None]:
    """Add to ``paths`` what is staged inside, for a caller that deletes it later."""
    _OPEN.append(paths)
    try:
        yield
    finally:
        _OPEN[:] = [p for p in _OPEN if p is not paths]


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is staged inside. Nothing that is still to be read may depend on it."""
    paths: list[str] = []
    try:
        with staged(paths):
            yield
    finally:
        delete(spark, paths)
