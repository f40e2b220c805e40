from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfsight.sinks import price_log as L
from shelfsight.sinks.backup import csv_backup, export
from shelfsight.sinks.encode import encode_nested, stamp
from shelfsight.sinks.jdbc import upsert_jdbc, upsert_statements
from shelfsight.sinks.keyed_table import KeyedTable
from shelfsight.sources.tables import load_best_source, scan_csv_latest, scan_table

TS = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)


def table(spark, tmp_path, key="asin", buckets=4):
    return KeyedTable(spark, str(tmp_path / "t"), key, buckets)


def batch(spark, *rows):
    return spark.createDataFrame(rows, "asin string, v int")


def content(t):
    return sorted(map(tuple, t.read().collect()), key=str)


def test_upsert_rules(spark, tmp_path):
    t = table(spark, tmp_path)
    assert scan_table(t) is None
    t.upsert(batch(spark, ("a", 1), ("b", 2), (None, 3)))
    assert content(t) == [("a", 1), ("b", 2), (None, 3)]
    t.upsert(batch(spark, ("a", 10), ("a", 11), ("c", 4), (None, 5)))
    assert content(t) == [("a", 10), ("a", 11), ("b", 2), ("c", 4), (None, 3), (None, 5)]


def test_upsert_twice_equals_once_for_keyed_rows(spark, tmp_path):
    t, rows = table(spark, tmp_path), batch(spark, ("a", 1), ("b", 2))
    t.upsert(rows)
    t.upsert(rows)
    assert content(t) == [("a", 1), ("b", 2)]
    t.upsert(batch(spark, (None, 1)))
    t.upsert(batch(spark, (None, 1)))
    assert content(t) == [("a", 1), ("b", 2), (None, 1), (None, 1)]


def test_upsert_adds_columns_and_refuses_changed_types(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(batch(spark, ("a", 1), ("b", 2)))
    t.upsert(spark.createDataFrame([("b", "x")], "asin string, extra string"))
    assert content(t) == [("a", 1, None), ("b", None, "x")]
    with pytest.raises(ValueError, match="v"):
        t.upsert(spark.createDataFrame([("a", "x")], "asin string, v string"))
    assert content(t) == [("a", 1, None), ("b", None, "x")]


def test_random_upserts_equal_a_dictionary(spark, tmp_path):
    t, expected = table(spark, tmp_path), {}
    for step in range(4):
        keys = [f"k{(step * 7 + i * i) % 40}" for i in range(25)]
        fresh = {}
        for i, k in enumerate(keys):
            fresh.setdefault(k, []).append(step * 100 + i)
        t.upsert(batch(spark, *[(k, v) for k, vs in fresh.items() for v in vs]))
        expected.update(fresh)
    assert content(t) == sorted(((k, v) for k, vs in expected.items() for v in vs), key=str)


def test_a_commit_id_is_written_once(spark, tmp_path):
    t = table(spark, tmp_path)
    for _ in range(2):
        t.upsert(batch(spark, ("a", 1), (None, 2)), commit_id="stream#0")
    assert content(t) == [("a", 1), (None, 2)]
    t.upsert(batch(spark, (None, 3)), commit_id="stream#1")
    assert content(t) == [("a", 1), (None, 2), (None, 3)]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path, buckets=64)
    t.upsert(batch(spark, *[(f"k{i}", i) for i in range(200)]))
    before = t._state().folders
    KeyedTable(spark, t.path, "asin", buckets=7).upsert(batch(spark, ("k1", -1)))
    after = t._state().folders
    assert sum(before[b] != after[b] for b in before) == 1
    assert t.read().count() == 200


def _listed(t):
    return {p for paths in t._state().folders.values() for p in paths}


def test_a_small_batch_rewrites_the_files_that_hold_its_keys(spark, tmp_path):
    t = table(spark, tmp_path, buckets=2)
    keys = spark.range(4000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("asin"), F.col("id").cast("int").alias("v"))
    for part in range(8):
        t.upsert(keys.where(F.col("v") % 8 == part))
    before = _listed(t)
    assert len(before) == 16
    t.upsert(batch(spark, ("k00008", -1), ("k00016", -2), ("new", -3)))
    # Both keys are of the first part; they lie in at most two of its files, and the new key in none.
    gone = before - _listed(t)
    assert 1 <= len(gone) <= 2 and t.read().count() == 4001
    assert t.read().where("v < 0").count() == 3 and t.read().where("asin = 'k00008'").first()["v"] == -1


def test_stored_rows_are_not_shuffled_for_few_keys(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path, buckets=2)
    t.upsert(batch(spark, *[(f"k{i}", i) for i in range(300)]))
    plans, write = [], KeyedTable._write

    def watched(self, df, folder, rebalance=True):
        if folder.endswith("/kept"):
            rows = self._bucketed(df) if not rebalance else self._bucketed(df).hint("rebalance", "key_bucket")
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, df, folder, rebalance)
    monkeypatch.setattr(KeyedTable, "_write", watched)
    t.upsert(batch(spark, ("k1", -1), ("k2", -2)))
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Join" not in plans[0]
    monkeypatch.setattr("shelfsight.sinks.keyed_table.FEW_KEYS", 1)
    t.upsert(batch(spark, ("k3", -1), ("k4", -2)))
    assert len(plans) == 2 and "Exchange" in plans[1]
    assert t.read().count() == 300 and t.read().where("v < 0").count() == 4


def test_keys_have_bloom_filters_where_dictionaries_are_given_up(spark, tmp_path):
    t = table(spark, tmp_path, buckets=1)
    t.upsert(spark.range(150_000).select(F.sha2(F.col("id").cast("string"), 256).alias("asin"), F.col("id").cast("int").alias("v")))
    jvm = spark._jvm
    for file in _listed(t):
        path = jvm.org.apache.hadoop.fs.Path(f"{t.path}/{file}")
        opened = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
            jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration()))
        column = opened.getFooter().getBlocks().get(0).getColumns().get(0)
        assert column.getPath().toDotString() == "asin" and column.getBloomFilterOffset() > 0
        opened.close()


def test_crowded_buckets_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("shelfsight.sinks.keyed_table.CROWDED", 3)
    t = table(spark, tmp_path, buckets=1)
    for i in range(6):
        t.upsert(batch(spark, (f"k{i}", i)))
    assert len(_listed(t)) <= 5 and content(t) == [(f"k{i}", i) for i in range(6)]


def test_vacuum_keeps_the_table_and_its_commits(spark, tmp_path):
    t = table(spark, tmp_path)
    for i in range(4):
        t.upsert(batch(spark, ("a", i), (f"k{i}", i), (None, i)), commit_id=f"run{i}")
    before, rows = len(list(tmp_path.rglob("*.parquet"))), content(t)
    assert t.vacuum() > 0 and content(t) == rows
    assert len(list((tmp_path / "t" / "manifest").glob("*.json"))) == 1
    assert len(list(tmp_path.rglob("*.parquet"))) == len(_listed(t)) < before
    t.upsert(batch(spark, ("a", 9)), commit_id="run2")
    assert content(t) == rows
    t.upsert(batch(spark, ("a", 9)), commit_id="run4")
    assert ("a", 9) in content(t) and len(content(t)) == len(rows)
    assert KeyedTable(spark, str(tmp_path / "none"), "asin").vacuum() == 0


def test_unfinished_write_is_invisible(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(batch(spark, ("a", 1)))
    t._write(batch(spark, ("a", 2)), "data/run-lost/new")
    assert content(t) == [("a", 1)]


def test_no_key_column_replaces_all(spark, tmp_path):
    t = table(spark, tmp_path, key=None)
    t.upsert(batch(spark, ("a", 1)))
    t.upsert(batch(spark, ("b", 2)).drop("asin"))
    assert t.read().columns == ["v"] and content(t) == [(2,)]
    t.replace_all(batch(spark).limit(0))
    assert content(t) == []


def test_a_batch_without_the_key_replaces_all(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(batch(spark, ("a", 1)))
    t.upsert(batch(spark, ("b", 2)).drop("asin"))
    assert content(t) == [(2,)]
    t.upsert(batch(spark, ("c", 3)))
    assert sorted(r["v"] for r in t.read().collect()) == [2, 3]


def test_encode_nested_and_stamp(spark):
    df = spark.createDataFrame([(["a"], {"k": None}, b"x", 1)], "l array<string>, m map<string,string>, b binary, n int")
    row = encode_nested(stamp(df, TS)).first()
    assert (row["l"], row["m"], row["b"], row["n"]) == ('["a"]', '{"k":null}', "x", 1)
    assert encode_nested(stamp(df, TS)).select(F.date_format("scraped_at", "yyyy-MM-dd HH:mm")).first()[0] == "2024-01-10 12:00"


def test_export_falls_back_to_the_backup(spark, tmp_path):
    out = str(tmp_path / "csv")
    df = spark.createDataFrame([("a", ["x"], 'say "hi"\nthere', 1.0)], "asin string, l array<string>, t string, best_price double")

    def broken(_):
        upsert_jdbc(df, "jdbc:nothing://nowhere", "t", "asin")

    report = export(df, "products", TS, broken, out)
    assert report.primary_error and report.backup_path.endswith("products_20240110_120000.csv")
    products, reviews = scan_csv_latest(spark, out)
    row = products.first()
    assert reviews is None and row["t"] == 'say "hi"\nthere' and row["l"] == '["x"]'
    assert export(df.limit(0), "products", TS, broken, out).skipped


def test_newest_backup_of_each_kind(spark, tmp_path):
    out = str(tmp_path / "csv")
    old, new = TS, TS.replace(day=11)
    csv_backup(spark.createDataFrame([(1.0,)], "best_price double"), out, "products", old)
    csv_backup(spark.createDataFrame([(2.0,)], "best_price double"), out, "products", new)
    csv_backup(spark.createDataFrame([("Positive",)], "sentiment string"), out, "reviews", old)
    products, reviews = scan_csv_latest(spark, out)
    assert products.first()[0] == 2.0 and reviews.first()[0] == "Positive"
    assert scan_csv_latest(spark, str(tmp_path / "none")) == (None, None)


def test_best_source(spark, tmp_path):
    products = KeyedTable(spark, str(tmp_path / "p"), "asin", 4)
    reviews = KeyedTable(spark, str(tmp_path / "r"), "asin", 4)
    out = str(tmp_path / "csv")
    assert load_best_source(spark, products, reviews, out) == (None, None, None)
    csv_backup(spark.createDataFrame([(1.0,)], "best_price double"), out, "products", TS)
    assert load_best_source(spark, products, reviews, out)[2] == "CSV Files"
    reviews.upsert(batch(spark, ("a", 1)))
    found_products, found_reviews, label = load_best_source(spark, products, reviews, out)
    assert label == "Tables" and found_products is None and found_reviews.count() == 1


def test_price_log(spark, tmp_path):
    path = str(tmp_path / "log")
    for day, price in ((10, 4.0), (12, 3.0), (20, 6.0)):
        df = spark.createDataFrame([("a", price, 5.0), (None, 1.0, 1.0)], "asin string, best_price double, rating double")
        L.append_log(stamp(df, TS.replace(day=day)), path)
    log = spark.read.parquet(path)
    assert L.latest_observations(log, columns=["best_price"]).collect()[0]["best_price"] == 6.0
    assert [r["price_change"] for r in L.price_changes(log).orderBy("scraped_at").collect()] == [None, -1.0, 3.0]
    weekly = L.weekly_trend(log).orderBy("week").collect()
    assert [(r["observations"], r["avg_price"], r["previous_avg_price"]) for r in weekly] == [(2, 3.5, None), (1, 6.0, 3.5)]
    assert "negative_pct" not in weekly[0].asDict()


def test_jdbc_upsert_statements():
    assert upsert_statements("t", "t_staging", "asin", ["asin", "v"]) == [
        'DELETE FROM t WHERE "asin" IN (SELECT "asin" FROM t_staging WHERE "asin" IS NOT NULL)',
        'INSERT INTO t ("asin", "v") SELECT "asin", "v" FROM t_staging',
    ]


def test_a_backup_from_one_task_has_several_files(spark, tmp_path, monkeypatch):
    """A file whose fields may hold line breaks is read by one task, so no file may grow with the table."""
    from shelfsight.sinks import backup
    from shelfsight.sources.tables import scan_csv

    monkeypatch.setattr(backup, "ROWS_PER_FILE", 4)
    rows = [(i, f"line {i}\nnext") for i in range(10)]
    df = spark.createDataFrame(rows, "k bigint, t string").coalesce(1)
    path = backup.csv_backup(df, str(tmp_path), "t", datetime(2024, 1, 10))
    assert len(list(Path(path).glob("part-*"))) == 3
    assert sorted(map(tuple, scan_csv(spark, path, df.schema).collect())) == rows


def test_a_large_batch_leaves_files_without_its_keys(spark, tmp_path, monkeypatch):
    from shelfsight.sinks import keyed_table

    monkeypatch.setattr(keyed_table, "FEW_KEYS", 2)
    table = keyed_table.KeyedTable(spark, str(tmp_path / "t"), "k", 2)

    def batch(first, last, v):
        return spark.createDataFrame([(f"k{i}", v) for i in range(first, last)], "k string, v int")

    table.upsert(batch(0, 50, 1))
    before = table.parts()[0]
    table.upsert(batch(50, 100, 2))
    assert set(before) < set(table.parts()[0])
    table.upsert(batch(40, 60, 3))
    found = sorted((int(r["k"][1:]), r["v"]) for r in table.read().collect())
    assert found == [(i, 3 if 40 <= i < 60 else 1 if i < 40 else 2) for i in range(100)]
