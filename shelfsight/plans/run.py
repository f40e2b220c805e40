"""One run: discover, enrich and store products, then collect, analyse and store reviews."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfsight.operators import quality as Q
from shelfsight.operators import rollups as C
from shelfsight.operators.answers import AnswerStore, Quota
from shelfsight.operators.batches import enrich_batches
from shelfsight.operators.ordering import FEW_KEYS
from shelfsight.operators.products import enrich_products
from shelfsight.operators.reviews import cap_reviews, reviews_for, with_recency
from shelfsight.schema import PLACE, PRODUCT_KEY, REVIEW_KEY, order_columns, resolve
from shelfsight.sinks.backup import ExportReport, export
from shelfsight.sinks.encode import stamp
from shelfsight.sinks.keyed_table import KeyedTable
from shelfsight.sinks.price_log import append_log
from shelfsight.sinks.rollup import RolledTable
from shelfsight.sources.discovery import discover_by_keyword, url_source
from shelfsight.staging import staged_until_done


@dataclass(frozen=True)
class Params:
    """Parameters of a run. The values are those a run uses unless told otherwise."""

    store_dir: str
    output_dir: str
    keywords: tuple[str, ...] = ("laptop stand", "wireless earbuds")
    limit_per_keyword: int = 10
    top_n_products: int = 4
    reviews_per_product: int = 25
    sort_by: str = "reviews_count"
    filter_unavailable: bool = False
    ai_batch_size: int = 10
    product_urls: tuple[str, ...] = ()
    review_order: tuple[str, ...] = PLACE
    history_dir: str | None = None
    product_table: str = "products"
    review_table: str = "reviews"
    buckets: int = 256
    rollups: bool = False
    answers_dir: str | None = None
    model: str = ""
    quota: Quota = Quota()
    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


@dataclass
class RunReport:
    """What a run did. A failed review branch leaves the products stored; ``no_reviews`` if it failed for want of any."""

    products: ExportReport | None = None
    reviews: ExportReport | None = None
    gates: dict[str, list[dict]] = field(default_factory=dict)
    review_error: str | None = None
    no_reviews: bool = False


def _staged(report: RunReport, name: str, df: DataFrame, label: str, gate: Callable) -> DataFrame:
    """Store a table for the steps that follow, and check it on the way."""
    stored, report.gates[name] = Q.stage_checked(df, label, gate, name)
    return stored


def stored_table(spark: SparkSession, name: str, key: str | None, params: Params) -> KeyedTable | RolledTable:
    """A run's table; with ``rollups`` its cube follows every write."""
    path = f"{params.store_dir}/{name}"
    if not params.rollups:
        return KeyedTable(spark, path, key, params.buckets)
    return RolledTable(spark, path, key, C.PRODUCT_CUBE if name == params.product_table else C.REVIEW_CUBE, params.buckets)


def _export(
    report: RunReport, df: DataFrame, name: str, key: str | None, params: Params, rows: float
) -> ExportReport:
    """Store a table and check what is stored, unless the store failed and only a backup exists.

    What is stored is checked by its cube, if it has one, and not read again.
    """
    table = stored_table(df.sparkSession, name, key, params)
    done = export(df, name, params.run_ts, table.upsert, params.output_dir, empty=rows == 0)
    if not done.skipped and done.primary_error is None:
        products = name == params.product_table
        if params.rollups:
            rows, gate = table.totals(), C.stored_products if products else C.stored_reviews
        else:
            rows, gate = table.read(), Q.stored_products if products else Q.stored_reviews
        title = f"stored {name}"
        report.gates[title] = Q.enforce(Q.evaluate(rows, gate(rows)), title)
    return done


def _count(report: RunReport, name: str) -> float:
    """The rows that a gate has counted."""
    return next(r["observed"] for r in report.gates[name] if r["name"] == "not_empty")


def collect_reviews(reviews: DataFrame, urls: DataFrame, params: Params) -> DataFrame:
    """Reviews of the chosen products, at most so many for each."""
    max_urls = max(params.top_n_products, len(params.product_urls))
    chosen = reviews_for(reviews, urls, max_urls)
    return cap_reviews(chosen, params.reviews_per_product, _arrival(chosen, params), FEW_KEYS)


def _arrival(df: DataFrame, params: Params) -> list[str]:
    """The columns of the review order that exist; without any, the key and then all columns that can be sorted."""
    wanted = [c for c in params.review_order if c in df.columns]
    if wanted:
        return wanted
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    key = resolve(df, REVIEW_KEY)
    return [c for c in (key, *[n for n in plain if n != key]) if c is not None]


def run_pipeline(
    spark: SparkSession,
    catalog: DataFrame,
    reviews: DataFrame,
    params: Params,
    scorer: Callable[[list[dict]], str] | None = None,
    responses: DataFrame | None = None,
) -> RunReport:
    """Run both branches and return a report. A failing product gate stops the run.

    A run that is repeated with the same ``run_ts`` stores the same. What it stages is deleted when it ends.
    """
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        raise ValueError("dates are read in UTC: set spark.sql.session.timeZone to UTC")
    with staged_until_done(spark):
        return _run(spark, catalog, reviews, params, scorer, responses)


def _run(
    spark: SparkSession, catalog: DataFrame, reviews: DataFrame, params: Params,
    scorer: Callable[[list[dict]], str] | None, responses: DataFrame | None,
) -> RunReport:
    report = RunReport()
    found = discover_by_keyword(catalog, params.keywords, params.limit_per_keyword)
    found = _staged(report, "raw products", order_columns(found.drop(*PLACE)), "discovered", Q.raw_products)

    # Both branches read the enriched products, so they are computed once.
    enriched = enrich_products(found, params.filter_unavailable)
    enriched = _staged(report, "enriched products", enriched, "enriched", Q.enriched_products)
    report.products = _export(
        report, enriched, params.product_table, resolve(enriched, PRODUCT_KEY), params, _count(report, "enriched products")
    )
    if params.history_dir and not report.products.skipped:
        append_log(stamp(enriched, params.run_ts), params.history_dir)

    try:
        urls = url_source(spark, enriched, params.product_urls, params.top_n_products, params.sort_by)
        collected = _staged(report, "raw reviews", collect_reviews(reviews, urls, params), "collected", Q.raw_reviews)
        order = _arrival(collected, params)
        store = AnswerStore(spark, params.answers_dir, params.quota) if params.answers_dir else None
        analysed = enrich_batches(collected, order, scorer, responses, params.ai_batch_size, store, params.model)
        analysed = with_recency(analysed, params.run_ts).drop(*PLACE, "batch_id")
        analysed = _staged(report, "analysed reviews", analysed, "analysed", Q.analysed_reviews)
        report.reviews = _export(
            report, analysed, params.review_table, resolve(analysed, REVIEW_KEY), params, _count(report, "analysed reviews")
        )
    except Exception as failure:
        report.review_error = f"{type(failure).__name__}: {failure}".splitlines()[0]
        report.no_reviews = isinstance(failure, Q.GateFailure) and failure.empty
    return report
