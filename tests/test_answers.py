"""Kept answers: who is asked, how often, and what is left after a run that dies."""

import json
import os
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import batches as B
from shelfsight.operators.answers import AnswerStore, Quota, RateLimit


def reviews(spark, n=50):
    return spark.range(n).select(
        "id", F.lit(5.0).alias("rating"), F.concat(F.lit("text "), (F.col("id") % 40).cast("string")).alias("body")
    )


def counting(folder, fatal="", fails=""):
    """A scorer that leaves a file for each call, kills its worker on a text and raises on another."""
    def score(items):
        texts = {i["text"] for i in items}
        calls = Path(folder) / items[0]["text"].replace(" ", "-")
        calls.mkdir(exist_ok=True)
        (calls / str(len(list(calls.iterdir())))).touch()
        if fatal in texts and not (Path(folder) / "killed").exists():
            (Path(folder) / "killed").touch()
            os._exit(1)
        if fails in texts:
            raise RuntimeError("busy")
        return json.dumps([{"index": n, "sentiment": "Neutral"} for n in range(1, len(items) + 1)])
    return score


def calls(folder):
    return {p.name: len(list(p.iterdir())) for p in Path(folder).iterdir() if p.is_dir()}


def sentiments(df):
    return {r["id"]: (r["sentiment"], r["analysis_method"]) for r in df.collect()}


def test_each_content_is_asked_once(spark, tmp_path):
    asked, store = tmp_path / "calls", AnswerStore(spark, str(tmp_path / "store"), per_task=2)
    asked.mkdir()
    # Ids 40 to 49 repeat the texts of 0 to 9: five batches of four contents.
    for _ in range(2):
        found = sentiments(B.enrich_batches(reviews(spark), ["id"], counting(asked), store=store))
        assert set(found.values()) == {("Neutral", "response")} and len(found) == 50
    assert calls(asked) == {f"text-{i}": 1 for i in (0, 10, 20, 30)}
    assert store.requests().agg(F.sum("calls")).first()[0] == 4
    other = AnswerStore(spark, str(tmp_path / "store"))
    B.enrich_batches(reviews(spark), ["id"], counting(asked), store=other, model="another")
    assert set(calls(asked).values()) == {2}


def test_a_killed_run_is_taken_up_where_it_ended(spark, tmp_path):
    asked, path = tmp_path / "calls", str(tmp_path / "store")
    asked.mkdir()
    store = AnswerStore(spark, path, lanes=1)
    with pytest.raises(Exception):
        B.enrich_batches(reviews(spark, 40), ["id"], counting(asked, fatal="text 25"), store=store)
    before = calls(asked)
    assert len(before) >= 2 or before == {"text-20": 1}
    found = sentiments(B.enrich_batches(reviews(spark, 40), ["id"], counting(asked, fatal="text 25"), store=AnswerStore(spark, path)))
    assert set(found.values()) == {("Neutral", "response")}
    # Only the call that the kill cut short was made again.
    assert calls(asked) == {"text-0": 1, "text-10": 1, "text-20": 2, "text-30": 1}


def test_failed_calls_are_asked_again(spark, tmp_path):
    asked, store = tmp_path / "calls", AnswerStore(spark, str(tmp_path / "store"))
    asked.mkdir()
    first = B.enrich_batches(reviews(spark, 20), ["id"], counting(asked, fails="text 3"), store=store)
    rows = {r["id"]: r for r in first.collect()}
    assert rows[3]["analysis_method"] == "rating" and rows[3]["analysis_error"] == "RuntimeError: busy"
    assert rows[13]["analysis_method"] == "response" and rows[13]["analysis_error"] is None
    second = sentiments(B.enrich_batches(reviews(spark, 20), ["id"], counting(asked), store=store))
    assert set(second.values()) == {("Neutral", "response")}
    assert calls(asked) == {"text-0": 2, "text-10": 1}


def test_quota_of_a_day(spark, tmp_path):
    asked, day = tmp_path / "calls", [1]
    asked.mkdir()
    store = AnswerStore(
        spark, str(tmp_path / "store"), Quota(per_day=2), lanes=4,
        clock=lambda: datetime(2024, 1, day[0], 12, tzinfo=timezone.utc),
    )
    # Two runs on one day, then one on the next: the quota is the day's and not the run's.
    for today, expected in ((1, 2), (1, 2), (2, 4)):
        day[0] = today
        found = B.enrich_batches(reviews(spark, 40), ["id"], counting(asked), store=store).collect()
        assert sum(calls(asked).values()) == expected
        left = [r for r in found if r["analysis_method"] == "rating"]
        assert len(left) == 40 - 10 * expected
        assert {r["analysis_error"] for r in left} <= {"not asked: the quota is used up"}


def test_no_minute_has_more_calls_than_allowed(spark, tmp_path):
    now, made = [0.0], []
    limit = RateLimit(15, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for n in (15, 5, 1, 15, 7, 15):
        limit.take(n)
        made += [now[0]] * n
        now[0] += 0.5
    assert all(sum(t <= x < t + 60 for x in made) <= 15 for t in made)
    paced = AnswerStore(spark, str(tmp_path / "store"), Quota(per_minute=2), limit=RateLimit(2, lambda: now[0], limit.sleep))
    start = now[0]
    B.enrich_batches(reviews(spark, 40), ["id"], B.rating_scorer(), store=paced)
    assert now[0] - start >= 60 and paced.answers().count() == 4


def test_no_batches(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "store"))
    assert B.enrich_batches(reviews(spark, 0), ["id"], counting(tmp_path), store=store).count() == 0
    assert store.answers().count() == 0 and store.requests().count() == 0


def test_texts_are_stored_only_for_batches_that_are_asked_about(spark, tmp_path, monkeypatch):
    from shelfsight.operators import answers
    from shelfsight.operators.batches import enrich_batches, rating_scorer

    paths, real = [], answers.scratch_path
    monkeypatch.setattr(answers, "scratch_path", lambda s, label: paths.append(real(s, label)) or paths[-1])
    df = spark.createDataFrame([(i, f"text {i}", 5.0) for i in range(60)], "id bigint, review_text string, rating double")
    store = answers.AnswerStore(spark, str(tmp_path / "answers"), answers.Quota(per_day=2))
    out = enrich_batches(df, ["id"], rating_scorer(), store=store)
    assert sorted(r[1] for r in out.groupBy("analysis_method").count().collect()) == [20, 40]
    asked = spark.read.parquet(paths[0])
    assert asked.count() == 2 and asked.agg({"ask": "max"}).first()[0] == 1
