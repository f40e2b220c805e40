"""Feed snapshots: JSON documents or newline-delimited JSON, with error records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.functions.text import single_json_value, strip
from shelfsight.sources.json_scan import read_array

#: Layouts of files that may hold lines of records.
LAYOUTS = ("document", "lines")


def _values(text: Column) -> Column:
    """The JSON texts in one piece of text: the elements of an array, or the value itself; null if bad."""
    value = single_json_value(text)
    return F.get(F.transform(F.array(value), lambda v: F.when(
        v.startswith("["), F.from_json(v, "array<string>")
    ).when(v.isNotNull(), F.array(v))), 0)


def _line_values(text: Column) -> Column:
    """The JSON texts of all lines, each line read on its own; bad and blank lines give nothing."""
    values = F.transform(F.split(text, "\n"), lambda line: _values(strip(line)))
    return F.flatten(F.filter(values, lambda v: v.isNotNull()))


def _objects(df: DataFrame) -> DataFrame:
    """Records are JSON objects; keep them with their place in the file."""
    return df.where(F.col("raw").startswith("{")).select("file", "seq", "pos", "raw")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Files that are one payload each: a JSON document, or else the records of all good lines."""
    files = spark.read.text(path, wholetext=True)
    texts = files.select(F.col("_metadata.file_path").alias("file"), strip(F.col("value")).alias("value"))
    records = F.coalesce(_values(F.col("value")), _line_values(F.col("value")))
    return _objects(
        texts.select("file", F.posexplode(records).alias("pos", "raw")).withColumn("seq", F.lit(0).cast("bigint"))
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON of any size; a file is split over many tasks.

    A line may also hold a whole array. Bad and blank lines are dropped. ``seq`` follows the file order.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("seq"),
        strip(F.col("value")).alias("value"),
    )
    return _objects(
        lines.where(F.col("value") != "")
        .select("file", "seq", F.posexplode(_values(F.col("value"))).alias("pos", "raw"))
    )


def read_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Files that are one JSON array each, of any size, read by as many tasks as they have splits.

    ``seq`` is the place of the record in bytes and ``pos`` 0. Records that are no valid JSON are dropped one by one.
    """
    raw = F.get(F.from_json(F.concat(F.lit("["), single_json_value(F.col("raw")), F.lit("]")), "array<string>"), 0)
    return _objects(read_array(spark, path).select("file", "seq", F.lit(0).alias("pos"), raw.alias("raw")))


def scan_snapshot(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """Records of a snapshot folder as ``(file, seq, pos, raw)``.

    ``raw`` is the JSON text of one object; ``seq`` and ``pos`` give its place in the file.

    The caller says how the files are laid out, so a record is found or not whatever the size of its file.
    ``"document"`` files may hold anything: one JSON document, over as many lines as it likes, or else a
    record on each line. Such a file is read by one task, as one text of up to 2 GB. ``"lines"`` files have a
    record on each line, or an array; they are split over many tasks. For such files both layouts give the
    same records. ``"array"`` files are one array each, or one object after the other, over as many lines as they
    like; they are split over many tasks too, whatever their size.
    """
    if layout == "array":
        return read_arrays(spark, path)
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {', '.join(LAYOUTS)} or array")
    return read_documents(spark, path) if layout == "document" else read_lines(spark, path)


def has_error(df: DataFrame) -> DataFrame:
    """Flag records that have an ``error`` key, whatever its value.

    Keys are only looked up where the text has such a name in it.
    """
    named = F.array_contains(F.json_object_keys("raw"), "error")
    return df.withColumn("is_error", F.col("raw").contains('"error"') & named)


def split_errors(df: DataFrame) -> DataFrame:
    """Records without an ``error`` key."""
    return has_error(df).where(~F.col("is_error")).drop("is_error")


def error_counts(df: DataFrame) -> DataFrame:
    """Good and error records of a load."""
    return has_error(df).agg(
        F.count("*").alias("records"),
        F.count_if(~F.col("is_error")).alias("successful"),
        F.count_if("is_error").alias("errors"),
    )


def record_fields(df: DataFrame) -> list[str]:
    """All keys that occur in the records, in name order; their number is that of the feed's fields."""
    keys = df.select(F.explode(F.json_object_keys("raw")).alias("name")).distinct().orderBy("name")
    return [row["name"] for row in keys.collect()]


def to_columns(df: DataFrame, schema: T.StructType, extra: bool = False) -> DataFrame:
    """Typed columns of the records; ``extra`` also adds unknown fields, as text."""
    fields = list(schema.fields)
    if extra:
        fields += [T.StructField(n, T.StringType()) for n in record_fields(df) if n not in schema.names]
    parsed = F.from_json("raw", T.StructType(fields)).alias("record")
    return df.select("file", "seq", "pos", parsed).select("file", "seq", "pos", "record.*")
