"""Batches of reviews for an external analyser, and matching its answers back to the reviews.

A batch is one row that holds at most ``size`` reviews, so every step after the grouping is a
row-wise expression and no group can grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions import numbers as N
from shelfsight.functions import reviews as R
from shelfsight.functions import text as X
from shelfsight.operators.answers import AnswerStore, Scorer, ask, content_digest
from shelfsight.operators.ordering import number_rows
from shelfsight.operators.reviews import analyse_by_rating, with_default_analysis
from shelfsight.schema import REVIEW_TEXT, resolve
from shelfsight.staging import stage

ANALYSIS = ("sentiment", "issues", "themes", "ai_summary", "analysis_method")


def assign_batches(df: DataFrame, order: Sequence[str | Column], size: int = 10) -> DataFrame:
    """Add ``batch_id`` and ``pos``: consecutive rows in ``order``, ``size`` to a batch."""
    index = F.col("_row")
    return (
        number_rows(df, order, "_row")
        .withColumn("pos", F.pmod(index, F.lit(size)).cast("int"))
        .withColumn("batch_id", ((index - F.pmod(index, F.lit(size))) / size).cast("bigint"))
        .drop("_row")
    )


def assemble_batches(batched: DataFrame) -> DataFrame:
    """One row per batch with the prompt text of its reviews, in order."""
    text = resolve(batched, REVIEW_TEXT)
    rating = N.number(batched, "rating") if "rating" in batched.columns else F.lit(None).cast("double")
    item = X.render_item(F.col("pos") + 1, rating, F.col(text))
    items = F.array_sort(F.collect_list(F.struct(F.col("pos"), item.alias("item"))))
    return batched.groupBy("batch_id").agg(
        F.count("*").cast("int").alias("n_reviews"),
        F.array_join(F.transform(items, lambda x: x["item"]), "").alias("reviews_text"),
    )


def _consecutive(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gathers rows ``batch_id, pos, item`` that stand in batch order: whole batches, and what a task has of others."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, items = None, []

        def taken(done: list[tuple[int, list[dict]]]) -> pa.RecordBatch:
            kind = pa.list_(pa.struct([("pos", pa.int32()), ("item", pa.string())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in done], pa.int64()), pa.array([x for _, x in done], kind)], ["batch_id", "items"]
            )

        for batch in batches:
            done = []
            for number, pos, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != at or len(items) == size:
                    if items:
                        done.append((at, items))
                    at, items = number, []
                items.append({"pos": pos, "item": item})
            yield taken(done)
        if items:
            yield taken([(at, items)])
    return gather


def prompt_batches(df: DataFrame, order: Sequence[str | Column], size: int = 10) -> DataFrame:
    """The rows of ``assemble_batches(assign_batches(df, order, size))``, without moving whole texts.

    Texts are cut to what a prompt shows before the one shuffle that puts the reviews in order. The stored rows then
    stand batch by batch, so a task cuts them into batches as it reads; only the batches over the border between two
    tasks, at most one each, are put together afterwards. ``order`` must not depend on the text.
    """
    text = resolve(df, REVIEW_TEXT)
    rating = N.number(df, "rating") if "rating" in df.columns else F.lit(None).cast("double")
    shown = df.withColumn("_shown", X.truncate_text(F.col(text))).drop(text).withColumn("_rating", rating)
    batched = assign_batches(shown, order, size)
    rows = batched.select("batch_id", "pos", X.render_item(F.col("pos") + 1, F.col("_rating"), F.col("_shown")).alias("item"))
    gathered = rows.mapInArrow(_consecutive(size), "batch_id bigint, items array<struct<pos: int, item: string>>")
    gathered = stage(gathered, "prompt-batches")
    whole = gathered.where(F.size("items") == size)
    parts = gathered.where(F.size("items") < size).groupBy("batch_id").agg(
        F.array_sort(F.flatten(F.collect_list("items"))).alias("items")
    )
    return whole.unionByName(parts).select(
        "batch_id", F.size("items").alias("n_reviews"),
        F.array_join(F.transform("items", lambda x: x["item"]), "").alias("reviews_text"),
    )


def _targets(answers: Column, size: Column) -> Column:
    """Answers with the position each one is for.

    An answer names its review by a 1-based index. An answer without a usable index goes to its own
    place in the list. Anything else is for no review.
    """
    def one(answer: Column, place: Column) -> Column:
        index = answer["index"]
        target = F.when(index.between(F.lit(1), size), index - 1).when(place < size, place)
        return F.struct(
            target.alias("target"),
            F.coalesce(answer["sentiment"], F.lit(R.UNKNOWN)).alias("sentiment"),
            F.coalesce(answer["issues"], F.array().cast("array<string>")).alias("issues"),
            F.coalesce(answer["themes"], F.array().cast("array<string>")).alias("themes"),
            F.coalesce(answer["summary"], F.lit("")).alias("ai_summary"),
        )
    return F.transform(answers, one)


def match_responses(batched: DataFrame, responses: DataFrame) -> DataFrame:
    """Give every review the last answer aimed at it.

    ``responses`` has one ``response`` text per ``batch_id``, and may have an ``error``. A batch without a usable
    response falls back to the rating rule, and ``analysis_error`` then has the error if there is such a column; in
    an answered batch a review without an answer stays ``Unknown``.
    """
    errors = ["error"] if "error" in responses.columns else []
    responses = responses.select("batch_id", "response", *[F.col(e).alias("_error") for e in errors])
    errors = ["_error" for _ in errors]
    kept = [c for c in batched.columns if c not in ("batch_id", *ANALYSIS)]
    if "rating" in kept:
        batched = batched.withColumn("rating", N.number(batched, "rating"))
    grouped = batched.groupBy("batch_id").agg(
        F.collect_list(F.struct(*kept)).alias("_reviews")
    )
    answered = (
        grouped.join(responses, "batch_id", "left")
        .withColumn("_answers", X.parse_response(F.col("response")))
        .withColumn("_answers", _targets(F.col("_answers"), F.size("_reviews")))
        .drop("response")
    )

    def pair(review: Column) -> Column:
        aimed = F.filter(F.col("_answers"), lambda a: a["target"] == review["pos"])
        return F.struct(review.alias("review"), F.try_element_at(aimed, F.lit(-1)).alias("answer"))

    rows = answered.select(
        "batch_id",
        F.col("_answers").isNotNull().alias("_answered"), *errors,
        F.explode(F.transform("_reviews", pair)).alias("_pair"),
    ).select("batch_id", "_answered", *errors, "_pair.review.*", F.col("_pair.answer").alias("_answer"))

    empty = F.array().cast("array<string>")
    by_rating = R.rating_sentiment(F.col("rating")) if "rating" in kept else F.lit(R.UNKNOWN)
    method = (
        F.when(~F.col("_answered"), "rating")
        .when(F.col("_answer").isNotNull(), "response")
        .otherwise("unmatched")
    )
    return rows.select(
        "batch_id", *kept,
        F.when(F.col("_answered"), F.coalesce("_answer.sentiment", F.lit(R.UNKNOWN)))
        .otherwise(by_rating).alias("sentiment"),
        F.coalesce("_answer.issues", empty).alias("issues"),
        F.coalesce("_answer.themes", empty).alias("themes"),
        F.coalesce("_answer.ai_summary", F.lit("")).alias("ai_summary"),
        method.alias("analysis_method"),
        *[F.col(e).alias("analysis_error") for e in errors],
    )


def batch_items(batched: DataFrame) -> DataFrame:
    """One row per batch with its reviews in order, as ``items`` of ``pos``, ``text`` and ``rating``."""
    text = resolve(batched, REVIEW_TEXT)
    rating = N.number(batched, "rating") if "rating" in batched.columns else F.lit(None).cast("double")
    item = F.struct(
        F.col("pos"), F.coalesce(F.col(text), F.lit("")).alias("text"), rating.alias("rating")
    )
    return batched.groupBy("batch_id").agg(F.array_sort(F.collect_list(item)).alias("items"))


def score_batches(batched: DataFrame, scorer: Scorer) -> DataFrame:
    """Call ``scorer`` once per batch with ``[{"text", "rating"}, ...]`` and keep its response text.

    A scorer that raises gives a null response, which leads to the rating rule for that batch, and the error's
    text in ``error``. A task that is repeated calls the scorer again; ``stored_responses`` does not.
    """
    return ask(batch_items(batched), scorer, "batch_id")


def stored_responses(batched: DataFrame, scorer: Scorer, store: AnswerStore, model: str = "") -> DataFrame:
    """``batch_id``, ``response`` and ``error`` of each batch, from answers that are kept.

    The scorer is called only for contents that ``model`` has not answered before, and within the store's quota. A batch
    that was not asked about for want of quota has no response and says so in ``error``.
    """
    batches = stage(
        batch_items(batched).select("batch_id", content_digest(model).alias("digest")), "batch-digests"
    )

    def items_of(wanted: DataFrame) -> DataFrame:
        """Whole texts are gathered again, and only for the batches that are asked about."""
        return batch_items(batched.join(wanted.select("batch_id"), "batch_id", "left_semi")).join(wanted, "batch_id")

    failed = store.ask_digests(batches, items_of, scorer)
    known = store.answers().select("digest", "response")
    answered = batches.select("batch_id", "digest").join(known, "digest", "left").join(failed, "digest", "left")
    reason = F.when(F.col("response").isNull(), F.coalesce("error", F.lit("not asked: the quota is used up")))
    return answered.select("batch_id", "response", reason.alias("error"))


def rating_scorer() -> Scorer:
    """A scorer that needs no service: it answers every review from its rating."""
    def score(reviews: list[dict]) -> str:
        import json

        def word(rating) -> str:
            if rating is None:
                return "Unknown"
            return "Positive" if rating >= 4 else "Neutral" if rating >= 3 else "Negative"

        return json.dumps([
            {"index": i, "sentiment": word(r["rating"]), "issues": [], "themes": [], "summary": ""}
            for i, r in enumerate(reviews, start=1)
        ])
    return score


def enrich_batches(
    df: DataFrame,
    order: Sequence[str | Column],
    scorer: Scorer | None = None,
    responses: DataFrame | None = None,
    size: int = 10,
    store: AnswerStore | None = None,
    model: str = "",
) -> DataFrame:
    """Analyse reviews by a scorer or by ready responses; without either, or without text, by rating.

    With a ``store``, answers of earlier runs are used again and new ones are kept.
    """
    if (scorer is None and responses is None) or resolve(df, REVIEW_TEXT) is None:
        return analyse_by_rating(df)
    batched = assign_batches(with_default_analysis(df).drop("analysis_method"), order, size)
    if responses is not None:
        answers = responses
    elif store is not None:
        answers = stored_responses(batched, scorer, store, model)
    else:
        answers = score_batches(batched, scorer)
    return match_responses(batched, answers)
