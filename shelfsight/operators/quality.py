"""Declarative data-quality gates, each evaluated in one aggregation or while the rows are being written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfsight.functions.numbers import number
from shelfsight.functions.reviews import SENTIMENTS, UNKNOWN
from shelfsight.schema import REVIEW_TEXT_AT_GATE, resolve
from shelfsight.staging import stage


@dataclass(frozen=True)
class Expectation:
    """An aggregate that must be at least (``min``) or at most (``max``) a threshold.

    ``rule="report"`` only reports the observed value. ``distinct`` marks aggregates that need equal values to meet,
    which rows that merely pass by cannot tell.
    """

    name: str
    observed: Column
    rule: str
    threshold: float | None = None
    distinct: bool = False

    def passes(self, value: float | None) -> bool:
        """Whether an observed value is good enough; a missing one is not, unless it is only reported."""
        if self.rule == "report":
            return True
        return value is not None and (value >= self.threshold if self.rule == "min" else value <= self.threshold)


class GateFailure(Exception):
    """A gate found data that must not go further. ``empty`` tells that there were no rows at all."""

    def __init__(self, message: str, empty: bool = False):
        super().__init__(message)
        self.empty = empty


def evaluate(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: name, passed, observed and threshold."""
    measured = df.agg(*[
        e.observed.cast("double").alias(f"m{i}") for i, e in enumerate(expectations)
    ])

    def row(i: int, e: Expectation) -> Column:
        value = F.col(f"m{i}")
        checks = {"min": value >= F.lit(e.threshold), "max": value <= F.lit(e.threshold), "report": F.lit(True)}
        return F.struct(
            F.lit(e.name).alias("name"),
            F.coalesce(checks[e.rule], F.lit(False)).alias("passed"),
            value.alias("observed"),
            F.lit(e.threshold).cast("double").alias("threshold"),
        )

    return measured.select(F.inline(F.array(*[row(i, e) for i, e in enumerate(expectations)])))


def enforce(report: DataFrame, gate: str) -> list[dict]:
    """Collect the few rows of a gate report, and raise if an expectation failed."""
    return _enforced([r.asDict() for r in report.collect()], gate)


def _enforced(rows: list[dict], gate: str) -> list[dict]:
    failed = [r for r in rows if not r["passed"]]
    if failed:
        detail = "; ".join(f"{r['name']}: {r['observed']} (threshold {r['threshold']})" for r in failed)
        raise GateFailure(f"{gate}: {detail}", any(r["name"] == "not_empty" for r in failed))
    return rows


def stage_checked(
    df: DataFrame, label: str, expectations: Callable[[DataFrame], Sequence[Expectation]], gate: str
) -> tuple[DataFrame, list[dict]]:
    """Write ``df`` to the shared folder and check it in the same pass; the stored rows, and the gate's.

    The aggregates are observed in the tasks that write. Only distinct counts are taken afterwards, from the stored
    column they are about. Raises as ``enforce`` does; the rows are stored by then, but nothing has read them.
    """
    wanted = list(expectations(df))
    passing = [e for e in wanted if not e.distinct]
    seen = Observation()
    columns = [e.observed.cast("double").alias(f"m{i}") for i, e in enumerate(passing)]
    stored = stage(df.observe(seen, *columns) if columns else df, label)
    values = {e.name: seen.get[f"m{i}"] for i, e in enumerate(passing)}
    later = [e for e in expectations(stored) if e.distinct]
    if later:
        counted = stored.agg(*[e.observed.cast("double").alias(f"m{i}") for i, e in enumerate(later)]).first()
        values.update({e.name: counted[i] for i, e in enumerate(later)})
    rows = [
        {"name": e.name, "passed": e.passes(values[e.name]), "observed": values[e.name], "threshold": e.threshold}
        for e in wanted
    ]
    return stored, _enforced(rows, gate)


def not_empty() -> Expectation:
    return Expectation("not_empty", F.count("*"), "min", 1.0)


def has_column(df: DataFrame, name: str, *candidates: str) -> Expectation:
    """A schema check; it costs nothing at run time."""
    present = resolve(df, candidates or (name,)) is not None
    return Expectation(f"has_{name}", F.lit(1.0 if present else 0.0), "min", 1.0)


def none_where(name: str, bad: Column) -> Expectation:
    return Expectation(name, F.count_if(bad), "max", 0.0)


def raw_products(df: DataFrame) -> list[Expectation]:
    """Gate for discovered products."""
    gate = [not_empty(), has_column(df, "title"), has_column(df, "url")]
    if "title" in df.columns:
        gate.append(none_where("null_titles", F.col("title").isNull()))
    if "final_price" in df.columns:
        gate.append(none_where("negative_prices", number(df, "final_price") < 0))
    if "asin" in df.columns:
        gate.append(Expectation("duplicate_asins", F.count("asin") - F.countDistinct("asin"), "max", 0.0, True))
    return gate


def raw_reviews(df: DataFrame) -> list[Expectation]:
    """Gate for collected reviews."""
    gate = [not_empty(), has_column(df, "text", *REVIEW_TEXT_AT_GATE)]
    if "rating" in df.columns:
        rating = number(df, "rating")
        gate.append(none_where("ratings_outside_1_5", (rating < 1) | (rating > 5)))
    key = resolve(df, ("asin", "product_asin"))
    if key:
        gate.append(Expectation("products_covered", F.countDistinct(key), "report", distinct=True))
    return gate


def enriched_products(df: DataFrame) -> list[Expectation]:
    """Gate for enriched products."""
    gate = [not_empty(), has_column(df, "best_price"), has_column(df, "price_tier")]
    if "best_price" in df.columns:
        price = number(df, "best_price")
        gate.append(Expectation("valid_prices", F.count(price), "min", 1.0))
        gate.append(none_where("prices_not_positive", price <= 0))
    if "rating" in df.columns:
        rating = number(df, "rating")
        gate.append(none_where("ratings_outside_0_5", (rating < 0) | (rating > 5)))
    if "discount_percent" in df.columns:
        gate.append(none_where("negative_discounts", number(df, "discount_percent") < 0))
    return gate


def analysed_reviews(df: DataFrame, min_coverage: float = 50.0) -> list[Expectation]:
    """Gate for analysed reviews."""
    gate = [not_empty()]
    gate += [has_column(df, name) for name in ("sentiment", "issues", "themes", "ai_summary")]
    if "sentiment" in df.columns:
        sentiment = F.col("sentiment")
        known = ~sentiment.eqNullSafe(F.lit(UNKNOWN))
        gate.append(none_where("invalid_sentiments", ~sentiment.isin(*SENTIMENTS)))
        gate.append(Expectation(
            "coverage_pct", F.avg(F.when(known, 1.0).otherwise(0.0)) * 100, "min", min_coverage
        ))
    return gate


def stored_products(df: DataFrame) -> list[Expectation]:
    """Gate for the stored product table."""
    return [not_empty()]


def stored_reviews(df: DataFrame) -> list[Expectation]:
    """Gate for the stored review table."""
    gate = [not_empty()]
    if "sentiment" in df.columns:
        known = F.col("sentiment").isNotNull() & (F.col("sentiment") != UNKNOWN)
        gate.append(Expectation("with_sentiment", F.count_if(known), "report"))
    return gate
