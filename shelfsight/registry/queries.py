"""One query for each operator, over whole driver tables.

Aggregated doubles are rounded so that the order of summation does not show.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.functions import numbers as N
from shelfsight.functions import text as X
from shelfsight.operators import batches as B
from shelfsight.operators import products as P
from shelfsight.operators import quality as Q
from shelfsight.operators import reports as R
from shelfsight.operators import reviews as V
from shelfsight.operators import rollups as C
from shelfsight.operators.answers import AnswerStore, Quota
from shelfsight.operators.describe import describe_all, describe_numeric
from shelfsight.operators.frequent import frequent
from shelfsight.operators.ordering import number_rows
from shelfsight.plans.context import data_context, filtered
from shelfsight.plans.run import Params, run_pipeline
from shelfsight.registry.projections import (
    AS_OF, raw_products, raw_reviews, responses, review_order, table, text_reviews,
)
from shelfsight.schema import PRODUCT_CONTEXT, RAW_PRODUCT, order_columns
from shelfsight.sinks import price_log as L
from shelfsight.sinks.backup import csv_backup, export
from shelfsight.sinks.encode import encode_nested, stamp
from shelfsight.sinks.key_bitmaps import KeyBitmaps
from shelfsight.sinks.keyed_table import KeyedTable
from shelfsight.sinks.price_intervals import PriceIntervals
from shelfsight.sinks.rollup import RolledTable
from shelfsight.sources import snapshot as S
from shelfsight.sources.discovery import discover_by_keyword, url_source
from shelfsight.sources.tables import load_best_source, newest_first, scan_csv_latest, scan_table
from shelfsight.staging import scratch_path
from shelfsight.streaming.alerts import current_windows, negative_windows, write_updates
from shelfsight.streaming.crossings import negative_crossings, write_alerts
from shelfsight.streaming.ingest import incremental_ingest

Query = Callable[[SparkSession, str], DataFrame]
RUN_TS = datetime(2024, 1, 10, tzinfo=timezone.utc)
_REGISTRY: dict[str, Query] = {}


def query(function: Query | None = None, *, name: str | None = None):
    """Register a query under its own name, or under ``name`` where an operator is already called that."""
    def register(f: Query) -> Query:
        _REGISTRY[name or f.__name__] = f
        return f
    return register(function) if function else register


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _text_time(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.enrich_products(raw_products(spark, sf_dir))


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with sentiment by rating, keeping their own issues, themes and summary."""
    df = raw_reviews(spark, sf_dir)
    kept = df.select("*", F.struct("issues", "themes", "ai_summary").alias("_own"))
    analysed = V.analyse_by_rating(kept)
    return analysed.withColumns({c: F.col(f"_own.{c}") for c in ("issues", "themes", "ai_summary")}).drop("_own")


_REVIEW_ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


# Products

@query
def numeric_coercion(spark, sf_dir):
    df = raw_products(spark, sf_dir)
    names = ("initial_price", "final_price", "rating", "reviews_count")
    return df.select("p_partkey", *[N.number(df, n).alias(n) for n in names])


@query
def enrich_products(spark, sf_dir):
    return _products(spark, sf_dir).select(
        "asin", "search_keyword", "initial_price", "final_price", "discount_amount", "discount_percent",
        "best_price", "price_tier", "rating", "rating_category", "reviews_count", "popularity", "main_category",
    )


@query
def column_order(spark, sf_dir):
    df = order_columns(raw_products(spark, sf_dir)).drop("categories", "discovery_input")
    names = F.array_join(F.array(*[F.lit(c) for c in df.columns]), ",")
    return df.select("asin", "title", names.alias("column_names"))


@query
def filter_available(spark, sf_dir):
    df = P.enrich_products(raw_products(spark, sf_dir), filter_unavailable=True)
    return df.select("asin", "availability", "best_price")


@query
def filter_min_rating(spark, sf_dir):
    return P.filter_products(_products(spark, sf_dir), min_rating=3.5).select("asin", "rating")


@query
def filter_keyword_tier(spark, sf_dir):
    products, _ = filtered(_products(spark, sf_dir), None, keyword="widget", tier=N.PRICE_LABELS[0])
    return products.select("asin", "search_keyword", "price_tier", "rating")


@query
def product_kpis(spark, sf_dir):
    """The average discount is infinite as soon as one product has a zero initial price."""
    kpis = _rounded(R.product_kpis(_products(spark, sf_dir)), "avg_price", "avg_rating", "avg_discount")
    return R.product_kpi_labels(kpis)


@query
def price_stats(spark, sf_dir):
    return _rounded(R.price_stats(_products(spark, sf_dir)), "avg_price", "avg_rating")


@query
def discounted_count(spark, sf_dir):
    return R.discounted_count(_products(spark, sf_dir))


@query
def count_by_keyword(spark, sf_dir):
    return R.count_by_keyword(_products(spark, sf_dir))


@query
def price_tier_counts(spark, sf_dir):
    return R.price_tier_counts(_products(spark, sf_dir))


@query
def distinct_options(spark, sf_dir):
    return R.distinct_options(_products(spark, sf_dir))


@query
def price_comparison(spark, sf_dir):
    return P.price_comparison(_products(spark, sf_dir))


@query
def rating_comparison(spark, sf_dir):
    return P.rating_comparison(_products(spark, sf_dir))


@query
def price_vs_rating(spark, sf_dir):
    return P.price_vs_rating(_products(spark, sf_dir))


@query
def product_table(spark, sf_dir):
    return P.product_table(_products(spark, sf_dir))


@query
def product_preview(spark, sf_dir):
    df = _products(spark, sf_dir)
    return P.product_preview(df, ["p_partkey"])


@query
def top_n_products(spark, sf_dir):
    top = P.top_n_products(_products(spark, sf_dir))
    return top.select("asin", "url", "reviews_count")


@query
def selection_preview(spark, sf_dir):
    return P.selection_preview(P.top_n_products(_products(spark, sf_dir)))


@query
def top3_by_rating(spark, sf_dir):
    return P.top3_by_rating(_products(spark, sf_dir)).select("asin", "title", "rating", "reviews_count")


@query
def reviews_for_top_products(spark, sf_dir):
    urls = url_source(spark, _products(spark, sf_dir), top_n=4)
    return V.reviews_for(raw_reviews(spark, sf_dir), urls, 4).select("asin", "url", *_REVIEW_ID)


@query(name="discover_by_keyword")
def discover_by_keyword_query(spark, sf_dir):
    found = discover_by_keyword(raw_products(spark, sf_dir), ("ring", "Red Widget", "wid get"), 10)
    return found.select("asin", "title", F.col("discovery_input.keyword").alias("keyword"))



# Reviews

@query
def cap_per_group(spark, sf_dir):
    return V.cap_reviews(raw_reviews(spark, sf_dir), 25, review_order()).select("asin", *_REVIEW_ID)


@query
def rating_sentiment(spark, sf_dir):
    return V.analyse_by_rating(raw_reviews(spark, sf_dir)).select(*_REVIEW_ID, "rating", "sentiment")


@query
def filter_sentiment(spark, sf_dir):
    _, reviews = filtered(None, _reviews(spark, sf_dir), sentiment="Negative")
    return reviews.select(*_REVIEW_ID, "sentiment")


@query
def sentiment_distribution(spark, sf_dir):
    return _rounded(R.sentiment_distribution(_reviews(spark, sf_dir)), "pct")


@query
def rating_distribution(spark, sf_dir):
    return _rounded(R.rating_distribution(_reviews(spark, sf_dir)), "avg_rating")


@query
def review_kpis(spark, sf_dir):
    kpis = _rounded(R.review_kpis(_reviews(spark, sf_dir)), "avg_rating", "negative_pct", "positive_pct")
    return R.review_kpi_labels(kpis)


@query
def parse_list(spark, sf_dir):
    df = raw_reviews(spark, sf_dir)
    return df.select(
        *_REVIEW_ID,
        F.array_join(X.parse_list(F.col("themes")), "|").alias("themes"),
        X.issue_suffix(X.parse_list(F.col("issues"))).alias("issue_text"),
    )


@query
def top_issues(spark, sf_dir):
    return R.top_issues(_reviews(spark, sf_dir), 10)


@query
def frequent_themes(spark, sf_dir):
    return R.frequent_items(_reviews(spark, sf_dir), "themes", 4)


@query
def frequent_words(spark, sf_dir):
    """The most frequent words of all documents, of which there are very many."""
    words = F.explode(F.split(F.lower("text"), r"[ \n]+"))
    return frequent(table(spark, sf_dir, "documents").select(words.alias("word")), F.col("word"), 20)


@query
def top_themes(spark, sf_dir):
    return R.top_themes(_reviews(spark, sf_dir), 15)


@query
def first_issues(spark, sf_dir):
    return R.first_issues(_reviews(spark, sf_dir), review_order())


@query
def review_recency(spark, sf_dir):
    df = V.with_recency(raw_reviews(spark, sf_dir), AS_OF)
    return _text_time(df, "review_date").select(*_REVIEW_ID, "review_date", "review_age_days", "is_recent")


@query
def parse_dates(spark, sf_dir):
    """Dates as text, in another notation for each line number."""
    day = F.col("date")
    notation = {1: "yyyy-MM-dd", 2: "MMMM d, yyyy", 3: "M/d/yyyy", 4: "yyyy-MM-dd'T'HH:mm:ss'Z'", 5: "d MMMM yyyy"}
    text = F.when(F.col("l_linenumber") == 6, "some day")
    for line, pattern in notation.items():
        text = text.when(F.col("l_linenumber") == line, F.date_format(day, pattern))
    df = V.with_recency(raw_reviews(spark, sf_dir).withColumn("date", text), AS_OF)
    return _text_time(df, "review_date").select(*_REVIEW_ID, "review_date", "review_age_days", "is_recent")


@query
def recent_counts(spark, sf_dir):
    return R.recent_counts(V.with_recency(_reviews(spark, sf_dir), AS_OF))


@query
def recent_negative(spark, sf_dir):
    df = V.recent_negative(V.with_recency(_reviews(spark, sf_dir), AS_OF))
    return df.select(*_REVIEW_ID, "review_age_days")


@query
def verified_share(spark, sf_dir):
    return _rounded(R.verified_share(_reviews(spark, sf_dir)), "verified_pct")


@query
def products_covered(spark, sf_dir):
    return R.products_covered(_reviews(spark, sf_dir))


@query
def analysis_coverage(spark, sf_dir):
    return _rounded(R.analysis_coverage(_reviews(spark, sf_dir)), "coverage_pct")


@query
def stored_coverage(spark, sf_dir):
    return R.stored_coverage(_reviews(spark, sf_dir))


@query
def has_analysis(spark, sf_dir):
    return V.has_analysis(_reviews(spark, sf_dir)).select(*_REVIEW_ID, "sentiment")


@query
def review_summary(spark, sf_dir):
    summary = R.review_summary(_reviews(spark, sf_dir), review_order(), ("rating-rule",))
    return _rounded(summary, "avg_rating", "negative_pct").withColumns({
        "models_used": F.array_join("models_used", "|"), "top_issues": F.array_join("top_issues", "|"),
    })


@query
def negative_rate_7d(spark, sf_dir):
    rates = R.negative_rate(_reviews(spark, sf_dir), AS_OF, keys=("asin",))
    names = raw_products(spark, sf_dir).select("asin", F.col("title").alias("product_name"))
    return _rounded(rates.join(names, "asin"), "negative_rate").select(
        "asin", "product_name", "negative_rate", "reviews"
    )


@query
def negative_rate_sql(spark, sf_dir):
    """The same rule as SQL, as a user of the stored tables would write it."""
    return spark.sql(
        """
        SELECT asin, round(avg(CASE WHEN sentiment = 'Negative' THEN 1 ELSE 0 END), 4) AS negative_rate
        FROM {reviews}
        WHERE scraped_at > :as_of - INTERVAL 7 DAYS
        GROUP BY asin
        HAVING avg(CASE WHEN sentiment = 'Negative' THEN 1 ELSE 0 END) > 0.2
        """,
        args={"as_of": AS_OF.replace(tzinfo=timezone.utc)}, reviews=_reviews(spark, sf_dir),
    )


@query
def summaries_by_sentiment(spark, sf_dir):
    df = R.summaries_by_sentiment(_reviews(spark, sf_dir), review_order())
    return df.select("sentiment", "group_size", "line", *_REVIEW_ID)


@query
def review_table(spark, sf_dir):
    return _text_time(R.review_table(_reviews(spark, sf_dir), review_order()), "date")


# Statistics and context

@query
def describe_products(spark, sf_dir):
    names = [c for c in PRODUCT_CONTEXT]
    stats = describe_all(_products(spark, sf_dir), names)
    return _rounded(stats, "mean", "std", "min", "p25", "p50", "p75", "max")


@query
def describe_reviews(spark, sf_dir):
    names = ("l_extendedprice", "rating", "l_suppkey")
    stats = describe_numeric(_reviews(spark, sf_dir), names)
    return _rounded(stats, "mean", "std", "min", "p25", "p50", "p75", "max")


@query
def context_products(spark, sf_dir):
    products = _products(spark, sf_dir)
    return data_context(products, None, ["p_partkey"], [])["product_sample"]()


@query
def context_reviews(spark, sf_dir):
    return data_context(None, _reviews(spark, sf_dir), [], review_order())["review_sample"]()


# Gates

def _gate(df: DataFrame, expectations) -> DataFrame:
    return _rounded(Q.evaluate(df, expectations(df)), "observed")


@query
def gate_raw_products(spark, sf_dir):
    return _gate(raw_products(spark, sf_dir), Q.raw_products)


@query
def gate_raw_reviews(spark, sf_dir):
    return _gate(text_reviews(spark, sf_dir), Q.raw_reviews)


@query
def gate_enriched_products(spark, sf_dir):
    return _gate(_products(spark, sf_dir), Q.enriched_products)


@query
def gate_analysed_reviews(spark, sf_dir):
    return _gate(_reviews(spark, sf_dir), Q.analysed_reviews)


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    target = KeyedTable(spark, scratch_path(spark, "gated"), "asin", buckets=16)
    target.upsert(df)
    return target.read()


@query
def gate_stored_products(spark, sf_dir):
    return _gate(_stored(spark, _products(spark, sf_dir)), Q.stored_products)


@query
def gate_stored_reviews(spark, sf_dir):
    return _gate(_stored(spark, _reviews(spark, sf_dir)), Q.stored_reviews)


@query
def skip_empty(spark, sf_dir):
    """An export of all products and one of a selection without any: the second one writes nothing."""
    folder, products = scratch_path(spark, "exports"), _products(spark, sf_dir)
    rows = []
    for name, df in (("all", products), ("none", products.where("p_partkey < 0"))):
        report = export(df, name, RUN_TS, KeyedTable(spark, f"{folder}/{name}", "asin", 16).upsert, f"{folder}/csv")
        count = F.count("*")
        stored = df if report.skipped else KeyedTable(spark, f"{folder}/{name}", "asin").read()
        rows.append(stored.agg(count.alias("stored")).select(F.lit(name).alias("name"), F.lit(report.skipped).alias("skipped"), "stored"))
    return rows[0].unionByName(rows[1])


@query
def enrich_empty(spark, sf_dir):
    """Enriching no products gives the enriched columns, which then take the enriched products."""
    raw = raw_products(spark, sf_dir)
    none = P.enrich_products(raw.where("p_partkey < 0"))
    return none.unionByName(P.enrich_products(raw)).select("asin", "price_tier", "rating_category", "main_category")


# Batches

def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.assign_batches(text_reviews(spark, sf_dir), ["doc_id"], 10)


@query
def row_numbers(spark, sf_dir):
    df = number_rows(raw_reviews(spark, sf_dir), review_order())
    return df.select(*_REVIEW_ID, "row_index")


@query
def assign_batches(spark, sf_dir):
    return _batched(spark, sf_dir).select("doc_id", "batch_id", "pos")


@query
def assemble_batches(spark, sf_dir):
    df = B.assemble_batches(_batched(spark, sf_dir))
    return df.select(
        "batch_id", "n_reviews", F.length("reviews_text").alias("n_chars"), F.md5("reviews_text").alias("digest")
    )


@query
def prompt_batches(spark, sf_dir):
    df = B.prompt_batches(text_reviews(spark, sf_dir), ["doc_id"])
    return df.select(
        "batch_id", "n_reviews", F.length("reviews_text").alias("n_chars"), F.md5("reviews_text").alias("digest")
    )


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = _batched(spark, sf_dir)
    return B.match_responses(batched, responses(batched))


@query
def match_responses(spark, sf_dir):
    return _matched(spark, sf_dir).select(
        "doc_id", "batch_id", "pos", "sentiment", F.array_join("issues", "|").alias("issues"),
        F.array_join("themes", "|").alias("themes"), "ai_summary", "analysis_method",
    )


@query
def method_counters(spark, sf_dir):
    return R.method_counters(_matched(spark, sf_dir))


@query
def enrich_batches(spark, sf_dir):
    df = B.enrich_batches(text_reviews(spark, sf_dir), ["doc_id"], B.rating_scorer())
    return df.select("doc_id", "rating", "sentiment", "analysis_method")


def _no_answer(items):
    raise RuntimeError("asked again")


@query
def enrich_batches_repeated(spark, sf_dir):
    """A run whose answers are kept, and its repetition, which may call nobody; ``calls`` counts both runs' calls."""
    reviews = text_reviews(spark, sf_dir)
    store = AnswerStore(spark, scratch_path(spark, "answers"), per_task=64)
    B.enrich_batches(reviews, ["doc_id"], B.rating_scorer(), store=store)
    again = B.enrich_batches(reviews, ["doc_id"], _no_answer, store=store)
    calls = store.requests().agg(F.sum("calls")).scalar()
    return again.select("doc_id", "sentiment", "analysis_method", calls.alias("calls"))


@query
def enrich_batches_quota(spark, sf_dir):
    """Two days on which three batches may be asked about: the others keep the rating rule."""
    reviews = text_reviews(spark, sf_dir)
    path = scratch_path(spark, "answers")
    for day in (1, 2):
        now = datetime(2024, 1, day, tzinfo=timezone.utc)
        store = AnswerStore(spark, path, Quota(per_day=3), per_task=64, clock=lambda now=now: now)
        df = B.enrich_batches(reviews, ["doc_id"], B.rating_scorer(), store=store)
    counted = df.groupBy("analysis_method").agg(F.countDistinct("batch_id").alias("batches"), F.count("*").alias("reviews"))
    return counted.select("analysis_method", "batches", (F.col("reviews") > 0).alias("any_review"))


# Storage

@query
def upsert_products(spark, sf_dir):
    """A second run replaces the products of one keyword; a third adds rows without a key."""
    df = encode_nested(_products(spark, sf_dir))
    target = KeyedTable(spark, scratch_path(spark, "products"), "asin", buckets=16)
    target.upsert(stamp(df, RUN_TS))
    target.upsert(stamp(df.where(F.col("search_keyword") == "widget"), RUN_TS.replace(day=11)))
    no_key = df.where(F.col("url").isNull()).withColumn("asin", F.lit(None).cast("string"))
    target.upsert(stamp(no_key, RUN_TS.replace(day=12)))
    return _text_time(target.read(), "scraped_at").select(
        "asin", "title", "best_price", "categories", "scraped_at"
    )


@query
def upsert_reviews(spark, sf_dir):
    """A second run brings only the negative reviews, and so replaces the products that have any."""
    df = _reviews(spark, sf_dir).drop("date")
    target = KeyedTable(spark, scratch_path(spark, "reviews"), "asin", buckets=16)
    target.upsert(df)
    target.upsert(df.where(F.col("sentiment") == "Negative").withColumn("second", F.lit(True)))
    return target.read().select(*_REVIEW_ID, "asin", "sentiment", "second")


@query
def replace_all(spark, sf_dir):
    df = _products(spark, sf_dir).drop("asin")
    target = KeyedTable(spark, scratch_path(spark, "keyless"), None)
    target.upsert(df)
    target.upsert(df.where(F.col("rating").isNotNull()))
    return target.read().select("p_partkey", "title", "rating")


@query
def csv_round_trip(spark, sf_dir):
    """Documents contain line breaks, quotes and non-ASCII text."""
    folder = scratch_path(spark, "backup")
    df = table(spark, sf_dir, "documents").withColumn("best_price", F.col("n_chars").cast("double"))
    csv_backup(df.withColumn("tags", F.array("lang", "source")), folder, "products", RUN_TS)
    back, _ = scan_csv_latest(spark, folder)
    return back.select(
        F.col("doc_id").cast("bigint"), F.md5("text").alias("digest"), "lang", "source",
        F.col("n_chars").cast("bigint"), "tags",
    )


@query
def best_source(spark, sf_dir):
    """Stored reviews exist and stored products do not, so the tables win."""
    folder = scratch_path(spark, "best")
    reviews = KeyedTable(spark, f"{folder}/reviews", "asin", buckets=16)
    reviews.upsert(_reviews(spark, sf_dir).drop("date"))
    _, found, label = load_best_source(
        spark, KeyedTable(spark, f"{folder}/products", "asin"), reviews, f"{folder}/csv"
    )
    return R.sentiment_distribution(found).select("sentiment", "count", F.lit(label).alias("source_label"))


@query(name="scan_table")
def scan_table_query(spark, sf_dir):
    """Stored products after two runs, newest first."""
    df = encode_nested(_products(spark, sf_dir))
    target = KeyedTable(spark, scratch_path(spark, "stored"), "asin", buckets=16)
    target.upsert(stamp(df, RUN_TS))
    target.upsert(stamp(df.where(F.col("rating") > 2.5), RUN_TS.replace(day=11)))
    found = newest_first(scan_table(target))
    return _text_time(found, "scraped_at").select("asin", "rating", "price_tier", "scraped_at")



@query
def backup_after_failure(spark, sf_dir):
    """The primary sink fails, the backup is written, and the reports read the backup."""
    folder = scratch_path(spark, "degraded")

    def broken(df: DataFrame) -> None:
        raise ConnectionError("no database")

    report = export(_products(spark, sf_dir), "products", RUN_TS, broken, f"{folder}/csv")
    products, _, label = load_best_source(
        spark, KeyedTable(spark, f"{folder}/products", "asin"), KeyedTable(spark, f"{folder}/reviews", "asin"),
        f"{folder}/csv",
    )
    counts = R.price_tier_counts(products)
    return counts.withColumns({"source_label": F.lit(label), "primary_error": F.lit(report.primary_error)})


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as price observations of a product."""
    return _reviews(spark, sf_dir).select(
        "asin", "scraped_at", F.col("l_extendedprice").alias("best_price"), "rating", "sentiment"
    )


@query
def price_history(spark, sf_dir):
    """Two runs appended to a log; the second sees other prices and only the better rated products."""
    path = scratch_path(spark, "price-log")
    df = _products(spark, sf_dir).select("asin", "best_price", "rating")
    L.append_log(stamp(df, RUN_TS), path)
    later = df.where(F.col("rating") > 1).withColumn("best_price", F.col("best_price") * 0.5)
    L.append_log(stamp(later, RUN_TS.replace(day=12)), path)
    changes = L.price_changes(spark.read.parquet(path))
    return _text_time(_rounded(changes, "best_price", "previous_price", "price_change"), "scraped_at")


@query
def price_intervals(spark, sf_dir):
    """Five runs kept as intervals of unchanged prices; each run sees other products, and every third run new prices."""
    df = _products(spark, sf_dir).select("asin", "p_partkey", "best_price")
    history = PriceIntervals(spark, scratch_path(spark, "intervals"))
    for run in range(5):
        seen = df.where(F.col("p_partkey") % 7 != run)
        factor = 1 + F.floor((F.col("p_partkey") + run) / 3) % 2
        history.append(seen.withColumn("best_price", F.col("best_price") * factor), RUN_TS.replace(day=10 + run))
    changes = history.changes()
    return _text_time(_rounded(changes, "best_price", "previous_price", "price_change"), "scraped_at")


@query
def price_latest(spark, sf_dir):
    latest = L.latest_observations(_log(spark, sf_dir), columns=["best_price", "rating"])
    return _text_time(latest, "scraped_at")


@query
def price_changes(spark, sf_dir):
    df = L.price_changes(_log(spark, sf_dir))
    return _text_time(_rounded(df, "best_price", "previous_price", "price_change"), "scraped_at")


@query
def price_weekly(spark, sf_dir):
    df = L.weekly_trend(_log(spark, sf_dir))
    names = [c for c in df.columns if c.endswith(("price", "rating", "pct"))]
    return _text_time(_rounded(df, *names), "week")


# Snapshots

def _payloads(spark: SparkSession, sf_dir: str) -> str:
    """A newline-delimited feed of the documents with error records, bad lines and blank lines."""
    record = F.to_json(F.struct("doc_id", F.col("text").alias("review_text"), F.col("source").alias("asin")))
    failed = F.concat(F.lit('{"error":null,"doc_id":'), F.col("doc_id").cast("string"), F.lit("}"))
    line = (
        F.when(F.col("doc_id") % 13 == 0, failed)
        .when(F.col("doc_id") % 17 == 0, F.concat(record, F.lit(",")))
        .when(F.col("doc_id") % 19 == 0, "  ")
        .when(F.col("doc_id") % 23 == 0, F.concat(F.lit("["), record, F.lit("]")))
        .otherwise(record)
    )
    path = scratch_path(spark, "feed")
    table(spark, sf_dir, "documents").select(line.alias("value")).write.text(path)
    return path


_DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("review_text", T.StringType()),
    T.StructField("asin", T.StringType()),
])


@query
def snapshot_json(spark, sf_dir):
    """The feed read by line, as large files are."""
    records = S.split_errors(S.scan_snapshot(spark, _payloads(spark, sf_dir), "lines"))
    return S.to_columns(records, _DOCUMENT).select("doc_id", "asin", F.md5("review_text").alias("digest"))


@query
def snapshot_array(spark, sf_dir):
    """The parts as JSON array documents of 500 records each, read whole."""
    path = scratch_path(spark, "arrays")
    record = F.to_json(F.struct(F.col("p_partkey"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand")))
    page = F.floor(F.col("p_partkey") / 500)
    documents = table(spark, sf_dir, "part").groupBy(page.alias("page")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(record), ",\n"), F.lit("\n]")).alias("value")
    )
    documents.select("value").write.option("maxRecordsPerFile", 1).text(path)
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), *RAW_PRODUCT.fields[:2]])
    return S.to_columns(S.scan_snapshot(spark, path), schema).select("p_partkey", "title", "brand")


@query
def snapshot_large_array(spark, sf_dir):
    """The documents as JSON arrays over many lines, cut into records by as many tasks as the files have splits."""
    path = scratch_path(spark, "large-arrays")
    record = F.to_json(F.struct("doc_id", "text", F.struct("lang", "source").alias("of")), {"pretty": "true"})
    # Every array also has elements that are no records.
    pages = table(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / 500).alias("page")).agg(
        F.concat(F.lit('[ 7, "}{", [{"no": 1}],\n'), F.array_join(F.collect_list(record), ",\n"), F.lit("\n]")).alias("value")
    )
    pages.select("value").write.option("maxRecordsPerFile", 1).text(path)
    schema = T.StructType.fromDDL("doc_id bigint, text string, of struct<lang string, source string>")
    found = S.to_columns(S.scan_snapshot(spark, path, "array"), schema)
    return found.select("doc_id", F.md5("text").alias("digest"), "of.lang", "of.source")


@query
def snapshot_mixed(spark, sf_dir):
    """The parts in one folder: objects and arrays over many lines, and lines with bad ones among them."""
    path = scratch_path(spark, "mixed")
    fields = F.struct(F.col("p_partkey"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand"))
    record, pretty = F.to_json(fields), F.to_json(fields, {"pretty": "true"})
    parts = table(spark, sf_dir, "part").withColumn("form", F.floor(F.col("p_partkey") / 100) % 3)
    line = F.when(F.col("p_partkey") % 17 == 3, F.concat(F.lit("["), record)).otherwise(record)
    whole = F.concat(F.lit("[\n"), F.array_join(F.collect_list(F.when(F.col("p_partkey") % 17 != 3, pretty)), ",\n"), F.lit("\n]"))
    page = F.floor(F.col("p_partkey") / 100).alias("page")
    arrays = parts.where("form = 0").groupBy(page).agg(whole.alias("value"))
    lines = parts.where("form = 1").groupBy(page).agg(F.array_join(F.collect_list(line), "\n").alias("value"))
    rest = parts.where("form = 2 AND p_partkey % 17 <> 3")
    objects = rest.where("p_partkey % 50 = 0").select(pretty.alias("value"))
    more = rest.where("p_partkey % 50 <> 0").groupBy(page).agg(F.array_join(F.collect_list(line), "\n").alias("value"))
    for df in (arrays, lines, objects, more):
        df.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(path)
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), *RAW_PRODUCT.fields[:2]])
    return S.to_columns(S.scan_snapshot(spark, path), schema).select("p_partkey", "title", "brand")


@query
def error_counts(spark, sf_dir):
    return S.error_counts(S.scan_snapshot(spark, _payloads(spark, sf_dir), "lines"))


@query
def csv_newest(spark, sf_dir):
    """Three backups, the older one of the products with other prices; the newest products are read back."""
    folder = scratch_path(spark, "backups")
    products = _products(spark, sf_dir).select("asin", "title", "best_price", "reviews_count")
    older = products.withColumn("best_price", F.lit(-1.0))
    for name, df, day in (("products", older, 8), ("products", products, 10), ("reviews", _reviews(spark, sf_dir).select("asin", "sentiment"), 9)):
        csv_backup(df, folder, name, RUN_TS.replace(day=day))
    back, reviews = scan_csv_latest(spark, folder, {"products": products.schema})
    sentiments = reviews.where("sentiment = 'Negative'").groupBy("asin").agg(F.count("*").alias("negative"))
    return _rounded(back, "best_price").join(sentiments, "asin", "left").select("asin", "best_price", "negative")


# Streams

@query
def negative_rate_stream(spark, sf_dir):
    """Events as reviews of a user: an error event is a negative one."""
    schema = table(spark, sf_dir, "events").schema
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    folder = scratch_path(spark, "alerts")
    windows = negative_windows(stream, "user_id", "ts", F.col("event_type") == "error")
    write_updates(windows, f"{folder}/updates", f"{folder}/checkpoint").awaitTermination()
    current = current_windows(spark.read.parquet(f"{folder}/updates"), "user_id")
    return _text_time(_rounded(current, "negative_rate"), "window_start")


@query
def negative_rate_sliding(spark, sf_dir):
    """For each day, the errors of a user's last seven days of events."""
    schema = table(spark, sf_dir, "events").schema
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    folder = scratch_path(spark, "sliding")
    windows = negative_windows(stream, "user_id", "ts", F.col("event_type") == "error", slide="1 day")
    write_updates(windows, f"{folder}/updates", f"{folder}/checkpoint").awaitTermination()
    current = current_windows(spark.read.parquet(f"{folder}/updates"), "user_id")
    return _text_time(_rounded(current, "negative_rate"), "window_start")


@query(name="negative_crossings")
def negative_crossings_query(spark, sf_dir):
    """Days on which a user's share of errors in the last seven days of events rises above a quarter."""
    schema = table(spark, sf_dir, "events").schema
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    folder = scratch_path(spark, "crossings")
    alerts = negative_crossings(stream, "user_id", "ts", F.col("event_type") == "error", "event_id", threshold=0.25)
    write_alerts(alerts, f"{folder}/alerts", f"{folder}/checkpoint").awaitTermination()
    found = spark.read.schema(alerts.schema).parquet(f"{folder}/alerts").drop("batch_id")
    return _rounded(found, "negative_rate").withColumn("day", F.col("day").cast("string"))


@query(name="incremental_ingest")
def incremental_ingest_query(spark, sf_dir):
    """Products arrive as files and are upserted by a stream; running it again finds nothing new."""
    folder = scratch_path(spark, "ingest")
    schema = table(spark, sf_dir, "part").schema
    target = KeyedTable(spark, f"{folder}/table", "p_partkey", buckets=16)
    for _ in range(2):
        incremental_ingest(
            spark, sf_dir, schema, target, f"{folder}/checkpoint",
            source_format="parquet", name_filter="part.parquet",
        ).awaitTermination()
    return target.read().select("p_partkey", "p_name", "p_retailprice")


@query
def ingest_by_run(spark, sf_dir):
    """Line items arrive as two runs of many files; a part keeps all rows of its latest run."""
    folder = scratch_path(spark, "runs")
    run = F.concat(F.lit("run="), F.when(F.col("l_linenumber") <= 2, 1).otherwise(2))
    rows = table(spark, sf_dir, "lineitem").select(*_REVIEW_ID, run.alias("run"))
    rows.repartition(6).write.parquet(f"{folder}/in")
    target = KeyedTable(spark, f"{folder}/table", "l_partkey", buckets=16)
    incremental_ingest(
        spark, f"{folder}/in", rows.schema, target, f"{folder}/checkpoint", run=F.col("run"), max_files=4,
        source_format="parquet",
    ).awaitTermination()
    return target.read().select(*_REVIEW_ID, "run")



# A whole run

def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalog. A product listed for nothing is listed for its final price."""
    catalog = raw_products(spark, sf_dir)
    listed = F.when(N.number(catalog, "initial_price") > 0, F.col("initial_price")).otherwise(F.col("final_price"))
    return catalog.withColumn("initial_price", listed).withColumn(
        "bought_past_month", (F.col("p_partkey") * 7 % 1500).cast("string")
    )


def _run(spark: SparkSession, sf_dir: str, folder: str, **other) -> None:
    """One run over the whole catalog. If no product or no review is left, its gate stops the run, which is no error here."""
    reviews = raw_reviews(spark, sf_dir).drop("issues", "themes", "ai_summary").withColumn(
        "review_text", F.concat_ws(" ", "asin", "l_orderkey")
    )
    options = dict(keywords=("ring", "widget"), review_order=tuple(_REVIEW_ID), buckets=16, run_ts=RUN_TS)
    params = Params(store_dir=f"{folder}/store", output_dir=f"{folder}/csv", **{**options, **other})
    try:
        report = run_pipeline(spark, _catalog(spark, sf_dir), reviews, params, scorer=B.rating_scorer())
    except Q.GateFailure as stopped:
        if not stopped.empty:
            raise
        return
    if report.review_error and not report.no_reviews:
        raise RuntimeError(report.review_error)


def _run_tables(spark: SparkSession, sf_dir: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """The products and reviews that runs stored; without rows if the runs came to none."""
    products, reviews = (KeyedTable(spark, f"{folder}/store/{n}", "asin").read_if_exists() for n in ("products", "reviews"))
    if products is None:
        products = P.enrich_products(_catalog(spark, sf_dir)).limit(0)
    if reviews is None:
        reviews = V.with_recency(_reviews(spark, sf_dir), RUN_TS).limit(0)
    return products, reviews


def _listed(report: str, df: DataFrame, item: str | None = None) -> DataFrame:
    """A report's numbers as ``(report, item, value)``: one row for each column, or for each value of ``item``."""
    numbers = [c for c in df.columns if c != item]
    name = (lambda c: F.concat_ws(" ", F.col(item).cast("string"), F.lit(c))) if item else F.lit
    pairs = F.array(*[F.struct(name(c).alias("item"), F.round(F.col(c).cast("double"), 4).alias("value")) for c in numbers])
    return df.select(F.lit(report).alias("report"), F.inline(pairs))


def _together(reports: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, reports)


@query
def products_over_runs(spark, sf_dir):
    """Different products of three runs, together, by sentiment and in common, from bitmaps alone."""
    df = _reviews(spark, sf_dir)
    store = KeyBitmaps(spark, scratch_path(spark, "bitmaps"))
    runs = {"early": "l_linenumber <= 2", "middle": "l_linenumber BETWEEN 3 AND 4", "late": "l_linenumber >= 5 AND rating >= 2"}
    for run, rows in runs.items():
        store.add(df.where(rows), run, F.col("sentiment"))
    counts = {"all": store.count(), "early or late": store.count(["early", "late"]), "early and late": store.both("early", "late")}
    listed = [c.select(F.lit(name).alias("which"), "products") for name, c in counts.items()]
    return functools.reduce(DataFrame.unionByName, listed, store.count_by_group().withColumnRenamed("group", "which"))


@query
def rollup_products(spark, sf_dir):
    """Product reports from partial sums, after an upsert of all products with a price and one of cheaper widgets."""
    df = _products(spark, sf_dir).where("p_partkey % 97 != 0")
    table = RolledTable(spark, scratch_path(spark, "rolled"), "asin", C.PRODUCT_CUBE, 16)
    table.upsert(df)
    table.upsert(df.where(F.col("search_keyword") == "widget").withColumn("best_price", F.col("best_price") / 2))
    cube = table.totals()
    return _together([
        _listed("kpis", C.product_kpis(cube)), _listed("prices", C.price_stats(cube)),
        _listed("discounted", C.discounted_count(cube)),
        _listed("keywords", C.value_counts(cube, "search_keyword"), "search_keyword"),
        _listed("tiers", C.value_counts(cube, "price_tier"), "price_tier"),
    ])


@query
def rollup_reviews(spark, sf_dir):
    """Review reports from partial sums, after three upserts of which the second replaces a third of the products."""
    rows = V.with_recency(_reviews(spark, sf_dir), AS_OF)
    table = RolledTable(spark, scratch_path(spark, "rolled"), "asin", C.REVIEW_CUBE, 16)
    table.upsert(rows.where("l_partkey % 3 != 2"))
    table.upsert(rows.where("l_partkey % 3 = 1").withColumn("sentiment", F.lit("Neutral")))
    table.upsert(rows.where("l_partkey % 3 = 2").withColumn("is_recent", F.lit(True)))
    cube = table.totals()
    return _together([
        _listed("kpis", C.review_kpis(cube)), _listed("recent", C.recent_counts(cube)),
        _listed("verified", C.verified_share(cube)), _listed("analysed", C.analysis_coverage(cube)),
        _listed("stored", C.stored_coverage(cube)), _listed("sentiments", C.sentiment_distribution(cube), "sentiment"),
        _listed("ratings", C.rating_distribution(cube), "rating"),
    ])


def _read_if_any(spark: SparkSession, read: Callable[[str], DataFrame], path: str) -> DataFrame:
    """The rows of a path, none if a run that came to no rows did not write it."""
    try:
        return read(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "asin string")


@query
def daily_run_repeated(spark, sf_dir):
    """A run and its repetition: tables, log and backups hold what one run stores."""
    folder = scratch_path(spark, "run-again")
    for _ in range(2):
        _run(spark, sf_dir, folder, history_dir=f"{folder}/history")
    products, reviews = _run_tables(spark, sf_dir, folder)
    written = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    paths = {"history": (spark.read.parquet, f"{folder}/history")} | {
        f"{n} backup": (written.csv, f"{folder}/csv/{n}_{RUN_TS:%Y%m%d_%H%M%S}.csv") for n in ("products", "reviews")
    }
    others = {n: _read_if_any(spark, *where) for n, where in paths.items()}
    tables = {"products": products, "reviews": reviews, **others}
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("stored"), "rows") for n, df in tables.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@query
def run_options(spark, sf_dir):
    """A run by overlapping keywords, available products only, chosen by a count stored as text."""
    folder = scratch_path(spark, "run-options")
    _run(
        spark, sf_dir, folder, keywords=("ring", "red"), limit_per_keyword=40, filter_unavailable=True,
        sort_by="bought_past_month", product_urls=("https://example.com/dp/none",),
    )
    products, reviews = _run_tables(spark, sf_dir, folder)
    found = products.select("asin", "search_keyword", F.col("bought_past_month").cast("long").alias("bought_past_month"))
    return reviews.join(found, "asin").select("asin", "search_keyword", "bought_past_month", "sentiment", *_REVIEW_ID)


@query
def daily_run(spark, sf_dir):
    """Discover, enrich, collect, analyse and store; then the stored reviews with their products."""
    folder = scratch_path(spark, "run")
    _run(spark, sf_dir, folder)
    products, stored = _run_tables(spark, sf_dir, folder)
    return stored.join(products.select("asin", "title", "search_keyword"), "asin").select(
        "asin", "title", "search_keyword", "sentiment", "review_age_days", *_REVIEW_ID
    )
