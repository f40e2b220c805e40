import json
from datetime import datetime, timezone

import pytest

from shelfsight.operators.quality import GateFailure
from shelfsight.plans.run import Params, run_pipeline
from shelfsight.schema import RAW_PRODUCT, RAW_REVIEW
from shelfsight.sinks.keyed_table import KeyedTable
from shelfsight.sinks.price_log import price_changes
from shelfsight.sources import snapshot
from shelfsight.sources.discovery import discover_by_keyword, url_source

CATALOG = "asin string, title string, url string, initial_price string, final_price string, rating string, reviews_count string"
REVIEWS = "seq bigint, url string, asin string, review_text string, rating string, date string"


def catalog(spark, price="9.5"):
    rows = [(f"A{i}", f"Laptop {'Stand' if i % 2 else 'bag'} {i}", f"u{i}", "10", price, "4", str(i)) for i in range(40)]
    return spark.createDataFrame(rows, CATALOG)


def reviews(spark):
    rows = [(i, f"u{i % 40}", f"A{i % 40}", f"t{i}", str(i % 5 + 1), "2024-01-01") for i in range(4000)]
    return spark.createDataFrame(rows, REVIEWS)


def params(tmp_path, **other):
    values = dict(
        store_dir=str(tmp_path / "store"), output_dir=str(tmp_path / "csv"), keywords=("laptop stand", "BAG"),
        buckets=4, run_ts=datetime(2024, 1, 10, tzinfo=timezone.utc),
    )
    return Params(**{**values, **other})


def stored(spark, tmp_path, name):
    return KeyedTable(spark, str(tmp_path / "store" / name), "asin").read()


def test_discovery(spark):
    found = discover_by_keyword(catalog(spark), ("stand LAPTOP", "bag", "nothing", "bag"), 3).collect()
    assert sorted((r["discovery_input"]["keyword"], r["asin"]) for r in found) == [
        ("bag", "A34"), ("bag", "A36"), ("bag", "A38"), ("stand LAPTOP", "A35"), ("stand LAPTOP", "A37"), ("stand LAPTOP", "A39"),
    ]


def test_url_source(spark):
    empty = catalog(spark).limit(0)
    assert [r[0] for r in url_source(spark, empty, ("x", "y")).collect()] == ["x", "y"]
    assert url_source(spark).count() == 0
    assert url_source(spark, catalog(spark), ("x",), top_n=2).count() == 2


def test_whole_run(spark, tmp_path):
    history = str(tmp_path / "history")
    report = run_pipeline(spark, catalog(spark), reviews(spark), params(tmp_path, history_dir=history))
    assert report.review_error is None and report.products.primary_error is None
    assert set(report.gates) == {
        "raw products", "enriched products", "stored products", "raw reviews", "analysed reviews", "stored reviews"}
    assert stored(spark, tmp_path, "products").count() == 20
    kept = stored(spark, tmp_path, "reviews")
    assert not {"seq", "batch_id"} & set(kept.columns)
    assert kept.count() == 100 and {r["review_age_days"] for r in kept.collect()} == {9}
    assert {r["count"] for r in kept.groupBy("asin").count().collect()} == {25}
    later = params(tmp_path, history_dir=history, run_ts=datetime(2024, 1, 11, tzinfo=timezone.utc))
    again = run_pipeline(spark, catalog(spark, "9"), reviews(spark), later)
    assert again.review_error is None
    changes = price_changes(spark.read.parquet(history)).where("price_change IS NOT NULL").collect()
    assert [r["price_change"] for r in changes] == [-0.5] * 20
    assert stored(spark, tmp_path, "products").count() == 20 and stored(spark, tmp_path, "reviews").count() == 100


def test_products_survive_a_failing_review_branch(spark, tmp_path):
    broken = reviews(spark).drop("review_text")
    report = run_pipeline(spark, catalog(spark), broken, params(tmp_path))
    assert "has_text" in report.review_error and report.reviews is None
    assert stored(spark, tmp_path, "products").count() == 20


def test_a_failing_product_gate_stops_the_run(spark, tmp_path):
    with pytest.raises(GateFailure, match="negative_discounts"):
        run_pipeline(spark, catalog(spark, price="12"), reviews(spark), params(tmp_path))
    assert not KeyedTable(spark, str(tmp_path / "store" / "products"), "asin").exists()


def test_run_from_snapshot_files(spark, tmp_path):
    products = [
        {"asin": f"A{i}", "title": f"laptop stand {i}", "url": f"u{i}", "initial_price": 20, "final_price": 15.5,
         "rating": 4.5, "reviews_count": i, "categories": ["Office", "Desk"]}
        for i in range(12)
    ] + [{"error": "blocked", "asin": "E"}]
    comments = [
        {"asin": f"A{i % 12}", "url": f"u{i % 12}", "review_text": f"text {i}", "rating": i % 5 + 1, "date": "January 2, 2024"}
        for i in range(600)
    ]
    (tmp_path / "p").mkdir()
    (tmp_path / "r").mkdir()
    (tmp_path / "p" / "a.json").write_text(json.dumps(products, indent=1))
    (tmp_path / "r" / "a.json").write_text("\n".join(map(json.dumps, comments[:300])))
    (tmp_path / "r" / "b.json").write_text(json.dumps(comments[300:]))

    def load(name, schema):
        return snapshot.to_columns(snapshot.split_errors(snapshot.scan_snapshot(spark, str(tmp_path / name))), schema)

    def scorer(items):
        return json.dumps([{"index": n, "sentiment": "Neutral", "themes": ["desk"]} for n in range(1, len(items) + 1)])

    chosen = params(tmp_path, keywords=("laptop stand",), top_n_products=3, reviews_per_product=7, ai_batch_size=4)
    report = run_pipeline(spark, load("p", RAW_PRODUCT), load("r", RAW_REVIEW), chosen, scorer=scorer)
    assert report.review_error is None
    kept = stored(spark, tmp_path, "reviews").collect()
    # The first seven of the three most reviewed products, in the order of the files.
    expected = [c["review_text"] for a in (11, 10, 9) for c in [c for c in comments if c["asin"] == f"A{a}"][:7]]
    assert sorted(r["review_text"] for r in kept) == sorted(expected)
    assert {(r["sentiment"], r["themes"][0], r["analysis_method"]) for r in kept} == {("Neutral", "desk", "response")}
    found = stored(spark, tmp_path, "products")
    assert found.count() == 10 and "seq" not in found.columns
    assert {(r["main_category"], r["discount_percent"], r["price_tier"]) for r in found.collect()} == {
        ("Office", 22.5, "Budget (<$25)")}
    assert (tmp_path / "csv" / "reviews_20240110_000000.csv").exists()


def test_a_run_with_rollups_and_kept_answers(spark, tmp_path):
    """The second run asks nobody, and its reports and gates come from partial sums."""
    from shelfsight.operators import reports as R
    from shelfsight.operators import rollups as C
    from shelfsight.operators.batches import rating_scorer
    from shelfsight.plans.run import stored_table

    def nobody(items):
        raise RuntimeError("asked again")

    plain = run_pipeline(spark, catalog(spark), reviews(spark), params(tmp_path / "plain"), rating_scorer())
    options = params(tmp_path, rollups=True, answers_dir=str(tmp_path / "answers"))
    for scorer in (rating_scorer(), nobody):
        report = run_pipeline(spark, catalog(spark), reviews(spark), options, scorer)
        assert report.review_error is None and report.gates == plain.gates
    rows = stored(spark, tmp_path, "reviews")
    assert {r["analysis_method"] for r in rows.select("analysis_method").distinct().collect()} == {"response"}
    tables = {name: stored_table(spark, name, "asin", options) for name in ("products", "reviews")}
    assert C.review_kpis(tables["reviews"].totals()).collect() == R.review_kpis(rows).collect()
    assert C.product_kpis(tables["products"].totals()).collect() == R.product_kpis(stored(spark, tmp_path, "products")).collect()


def test_a_run_reads_each_staged_table_once_for_its_gates(spark, tmp_path, monkeypatch):
    """The gates of staged tables are observed; only those of stored tables are evaluated by a job."""
    from shelfsight.operators import quality

    evaluated, real = [], quality.evaluate
    monkeypatch.setattr(quality, "evaluate", lambda df, e: evaluated.append(1) or real(df, e))
    report = run_pipeline(spark, catalog(spark), reviews(spark), params(tmp_path))
    assert len(report.gates) == 6 and len(evaluated) == 2


@pytest.mark.parametrize(("partkeys", "name"), [((2, 6, 10), "red ring"), ((1, 5, 9), "red ring"), ((1, 5), "big bolt")])
def test_run_queries_without_products_or_reviews(spark, tmp_path, partkeys, name):
    """None is available, none has a review, none is found: the queries have no rows, as their SQL."""
    from shelfsight.registry.queries import all_queries

    spark.createDataFrame([(k, name, "b", 1000.0, 7, "t") for k in partkeys],
        "p_partkey bigint, p_name string, p_brand string, p_retailprice double, p_size int, p_type string",
    ).write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1, 1, 900, 1, 5.0, 7.0, "N", "O", datetime(1998, 1, 1))],
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double,"
        " l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    run_options = all_queries()["run_options"](spark, str(tmp_path))
    assert run_options.collect() == [] and dict(run_options.dtypes)["bought_past_month"] == "bigint"
    assert all_queries()["daily_run"](spark, str(tmp_path)).collect() == []
    counts = {r["stored"]: r["rows"] for r in all_queries()["daily_run_repeated"](spark, str(tmp_path)).collect()}
    products = len(partkeys) if name == "red ring" else 0
    assert counts == {
        "products": products, "history": products, "products backup": products, "reviews": 0, "reviews backup": 0}
