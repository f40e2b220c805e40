import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.sinks.keyed_table import KeyedTable
from shelfsight.streaming.alerts import (
    current_windows, late_rows, merge_updates, negative_alerts, negative_windows, read_updates, write_updates,
)
from shelfsight.streaming.ingest import incremental_ingest

SCHEMA = T.StructType([T.StructField("asin", T.StringType()), T.StructField("price", T.DoubleType())])


def drop(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))


def test_ingest_takes_each_file_once(spark, tmp_path):
    source, target = tmp_path / "in", KeyedTable(spark, str(tmp_path / "t"), "asin", 4)

    def run():
        by_file = F.col("_metadata.file_name")
        incremental_ingest(spark, str(source), SCHEMA, target, str(tmp_path / "cp"), run=by_file).awaitTermination()
        return sorted(map(tuple, target.read().drop("ingest_run").collect()), key=str)

    drop(source, "1.json", {"asin": "a", "price": 1}, {"asin": None, "price": 9})
    assert run() == [("a", 1.0), (None, 9.0)]
    assert run() == [("a", 1.0), (None, 9.0)]
    drop(source, "2.json", {"asin": "a", "price": 2}, {"asin": "b", "price": 3})
    assert run() == [("a", 2.0), ("b", 3.0), (None, 9.0)]


@pytest.mark.parametrize("max_files", [1, 1000])
def test_files_of_a_run_belong_together(spark, tmp_path, max_files):
    for run, file, price in ((2, "a", 5), (1, "a", 1), (1, "b", 2), (2, "b", 6), (2, "c", 7)):
        folder = tmp_path / "in" / f"run={run}"
        folder.mkdir(parents=True, exist_ok=True)
        drop(folder, f"{file}.json", {"asin": "x", "price": price}, {"asin": f"only{run}{file}", "price": price})
    target = KeyedTable(spark, str(tmp_path / "t"), "asin", 4)
    schema = SCHEMA
    incremental_ingest(
        spark, str(tmp_path / "in"), schema, target, str(tmp_path / "cp"), max_files=max_files
    ).awaitTermination()
    rows = target.read().collect()
    assert sorted(r["price"] for r in rows if r["asin"] == "x") == [5, 6, 7] and len(rows) == 8


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    source, start = tmp_path / "in", datetime(2024, 1, 1)
    stream_schema = "asin string, sentiment string, scraped_at timestamp"
    total = []
    for part in range(3):
        rows = [
            {"asin": f"p{i % 3}", "sentiment": "Negative" if i % 4 == 0 else "Positive",
             "scraped_at": (start + timedelta(days=part * 5, hours=i)).isoformat()}
            for i in range(60)
        ]
        total += rows
        drop(source, f"{part}.json", *rows)
        stream = spark.readStream.schema(stream_schema).option("maxFilesPerTrigger", 1).json(str(source))
        write_updates(negative_windows(stream), str(tmp_path / "u"), str(tmp_path / "cp")).awaitTermination()
    got = current_windows(spark.read.parquet(str(tmp_path / "u")))
    batch = spark.read.schema(stream_schema).json(str(source)).groupBy(F.window("scraped_at", "7 days"), "asin").agg(
        F.count("*").alias("n"), F.count_if(F.col("sentiment") == "Negative").alias("neg")
    )
    left = {(r["window_start"], r["asin"], r["reviews"], r["negative"]) for r in got.collect()}
    assert left == {(r["window"]["start"], r["asin"], r["n"], r["neg"]) for r in batch.collect()}
    assert sum(x[2] for x in left) == len(total)
    assert negative_alerts(got, 0.2).count() <= got.count()


def test_late_rows_are_dropped(spark, tmp_path):
    source, late = tmp_path / "in", []
    schema = "asin string, sentiment string, scraped_at timestamp"

    def run():
        stream = spark.readStream.schema(schema).json(str(source))
        query = write_updates(negative_windows(stream), str(tmp_path / "u"), str(tmp_path / "cp"))
        query.awaitTermination()
        late.append(late_rows(query))
        return current_windows(spark.read.parquet(str(tmp_path / "u"))).agg(F.sum("reviews")).first()[0]

    drop(source, "1.json", {"asin": "a", "sentiment": "Negative", "scraped_at": "2024-03-01T00:00:00"})
    assert run() == 1
    drop(source, "2.json", {"asin": "a", "sentiment": "Negative", "scraped_at": "2024-03-02T00:00:00"})
    assert run() == 2
    drop(source, "3.json", {"asin": "a", "sentiment": "Negative", "scraped_at": "2023-01-01T00:00:00"})
    assert run() == 2
    assert late == [0, 0, 1]


def test_merged_updates_give_the_same_windows(spark, tmp_path):
    source, path, start = tmp_path / "in", str(tmp_path / "u"), datetime(2024, 1, 1)
    schema = "asin string, sentiment string, scraped_at timestamp"

    def run(part):
        drop(source, f"{part}.json", *[
            {"asin": f"p{i % 3}", "sentiment": "Negative" if i % 4 == 0 else "Positive",
             "scraped_at": (start + timedelta(days=part * 2, hours=i)).isoformat()} for i in range(40)
        ])
        stream = spark.readStream.schema(schema).json(str(source))
        write_updates(negative_windows(stream), path, str(tmp_path / "cp")).awaitTermination()
        return sorted(map(tuple, current_windows(read_updates(spark, path)).collect()))

    with pytest.raises(FileNotFoundError):
        read_updates(spark, path)
    assert merge_updates(spark, path) == -1
    for part in range(4):
        found = run(part)
        if part != 1:
            last = merge_updates(spark, path)
            assert merge_updates(spark, path) == last
            assert sorted(map(tuple, current_windows(read_updates(spark, path)).collect())) == found
            assert [p.name for p in (tmp_path / "u").iterdir()] == ["merged"]
            assert [p.name for p in (tmp_path / "u" / "merged").iterdir()] == [f"upto={last}"]
    batch = spark.read.schema(schema).json(str(source)).groupBy(F.window("scraped_at", "7 days"), "asin").count()
    assert sorted((r[0], r[1], r[2]) for r in found) == sorted((r["window"]["start"], r["asin"], r["count"]) for r in batch.collect())
