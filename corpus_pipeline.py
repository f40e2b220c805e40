"""A corpus pipeline of five stages, each on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.decontaminate import decontaminate
from shelfsight.llm.exact_dedup import exact_dedup
from shelfsight.llm.mixing import mix
from shelfsight.llm.quality import resample
from shelfsight.llm.queries import good_label
from shelfsight.llm.simhash import near_dedup
from shelfsight.staging import delete, stage, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []


def _tidy(function: Stage) -> Stage:
    """A stage that first deletes what the stages before it staged.

    Their rows have been written by then and are read from there. Tables that ``docs`` still reads, because a caller
    did not write them, stay. The tables of the last stage belong to its result and stay as well.
    """
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _left else []
        # A staged table's own name is unique; how its folder is written may differ.
        done = [p for p in _left if not any(p.rpartition("/")[2] in f for f in read)]
        delete(spark, done)
        _left[:] = [p for p in _left if p not in done]
        with staged(_left):
            return function(spark, docs, sf_dir)
    return run_stage


@_tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), good_label())


@_tidy
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


@_tidy
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup(docs)


@_tidy
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    whole = docs.select(F.struct("*").alias("_document"), "text")
    found = decontaminate(whole, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where("NOT contaminated").select("_document.*")


@_tidy
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, and how often it repeats each."""
    return mix(docs).where("repeats > 0")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", decontaminated), ("mix", mixed),
]
#: Resampling has no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are written and read again for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, function in STAGES:
        after: list[str] = []
        result = function(spark, docs, sf_dir)
        with staged(after):
            docs = stage(result, f"pipeline-{name}")
        delete(spark, before)
        before = after
    return docs


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def all_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
