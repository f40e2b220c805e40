import json
import random

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import batches as B


def sequential(size, ratings, text):
    """The matching rule as a loop: what each review of one batch ends up with."""
    def fallback(r):
        return "Unknown" if r is None else "Positive" if r >= 4 else "Neutral" if r >= 3 else "Negative"
    try:
        answers = json.loads(text) if text else []
    except ValueError:
        answers = []
    if not answers:
        return [(fallback(r), "", "rating") for r in ratings]
    result = [("Unknown", "", "unmatched")] * size
    matched = 0
    for answer in answers:
        index = answer.get("index")
        if index is not None and 1 <= index <= size:
            target = index - 1
        elif matched < size:
            target = matched
        else:
            continue
        result[target] = (answer.get("sentiment", "Unknown"), answer.get("summary", ""), "response")
        matched += 1
    return result


def test_matching_equals_the_sequential_rule(spark):
    rng = random.Random(7)
    reviews, responses, expected = [], [], {}
    for batch in range(300):
        size = rng.randint(1, 6)
        ratings = [rng.choice([None, 1.0, 3.0, 5.0]) for _ in range(size)]
        answers = []
        for n in range(rng.randint(0, 8)):
            answer = {"sentiment": rng.choice(["Positive", "Negative"]), "summary": f"{batch}.{n}"}
            index = rng.choice([None, 0, 1, 2, 3, 4, 5, 6, 7, 99, -1])
            if index is not None or rng.random() < 0.5:
                answer["index"] = index
            answers.append(answer)
        text = rng.choice([json.dumps(answers)] * 4 + ["", "junk", None])
        reviews += [(batch, pos, rating) for pos, rating in enumerate(ratings)]
        if rng.random() < 0.9:
            responses.append((batch, text))
        else:
            text = None
        for pos, outcome in enumerate(sequential(size, ratings, text)):
            expected[batch, pos] = outcome
    got = B.match_responses(
        spark.createDataFrame(reviews, "batch_id bigint, pos int, rating double"),
        spark.createDataFrame(responses, "batch_id bigint, response string"),
    )
    rows = {(r["batch_id"], r["pos"]): (r["sentiment"], r["ai_summary"], r["analysis_method"]) for r in got.collect()}
    assert rows == expected


@pytest.mark.parametrize("response, expected", [
    ('[{"index":1,"sentiment":"A"},{"index":2,"sentiment":"B"},{"index":3,"sentiment":"C"}]', "ABC"),
    ('[{"index":3,"sentiment":"C"},{"index":1,"sentiment":"A"}]', "AUC"),
    ('[{"index":"2","sentiment":"A"},{"index":null,"sentiment":"B"}]', "ABU"),
    ('{"index":2,"sentiment":"B"}', "UBU"),
    ('```json\n[{"index":2,"sentiment":"B"}]\n```\nbye', "UBU"),
    ('[{"index":1,"sentiment":"A"},{"index":1,"sentiment":"B"}]', "BUU"),
    ('[{"index":9,"sentiment":"A"},{"index":9,"sentiment":"B"},{"index":9,"sentiment":"C"},{"index":9,"sentiment":"D"}]', "ABC"),
])
def test_response_shapes(spark, response, expected):
    reviews = spark.createDataFrame([(0, p, 5.0) for p in range(3)], "batch_id bigint, pos int, rating double")
    responses = spark.createDataFrame([(0, response)], "batch_id bigint, response string")
    rows = sorted(B.match_responses(reviews, responses).collect(), key=lambda r: r["pos"])
    assert "".join(r["sentiment"][0] for r in rows) == expected


def reviews(spark, n=23):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 4 != 0, (F.col("id") % 5 + 1).cast("double")).alias("rating"),
        F.concat(F.lit("text "), "id").alias("body"),
    )


def test_batches_are_consecutive(spark):
    df = B.assign_batches(reviews(spark), [F.desc("id")], 10)
    got = {r["id"]: (r["batch_id"], r["pos"]) for r in df.collect()}
    assert got == {i: ((22 - i) // 10, (22 - i) % 10) for i in range(23)}
    texts = {r["batch_id"]: r for r in B.assemble_batches(df).collect()}
    assert [texts[b]["n_reviews"] for b in range(3)] == [10, 10, 3]
    assert texts[2]["reviews_text"].startswith("\n[Review 1] (Rating: 3.0/5)\ntext 2\n\n[Review 2]")


@pytest.mark.parametrize("size", [1, 3, 10, 100])
def test_prompts_without_moving_whole_texts(spark, size):
    df = reviews(spark, 137).withColumn("body", F.concat("body", F.repeat(F.lit("é"), 600))).repartition(7)
    order = [F.desc("id")]
    whole = B.assemble_batches(B.assign_batches(df, order, size))
    rows = [sorted(map(tuple, x.collect())) for x in (whole, B.prompt_batches(df, order, size))]
    assert rows[0] == rows[1] and len(rows[0]) == -(-137 // size)
    assert B.prompt_batches(df.limit(0), order, size).count() == 0
    assert B.prompt_batches(df.drop("rating"), order, size).count() == len(rows[0])


def test_scorer_and_fallback(spark):
    def failing(items):
        if any(i["text"] == "text 5" for i in items):
            raise RuntimeError("no quota")
        return json.dumps([{"index": n, "sentiment": "Neutral"} for n in range(1, len(items))])

    rows = {r["id"]: r for r in B.enrich_batches(reviews(spark), ["id"], failing).collect()}
    assert {rows[i]["analysis_method"] for i in range(10)} == {"rating"}
    assert rows[3]["sentiment"] == "Positive" and rows[4]["sentiment"] == "Unknown"
    assert rows[10]["analysis_method"] == "response" and rows[10]["sentiment"] == "Neutral"
    assert rows[19]["analysis_method"] == "unmatched" and rows[19]["sentiment"] == "Unknown"
    assert rows[10].asDict().keys() >= {"body", "issues", "themes", "ai_summary"}
    assert rows[3]["analysis_error"] == "RuntimeError: no quota" and rows[10]["analysis_error"] is None


def test_without_text_or_scorer_the_rating_decides(spark):
    df = reviews(spark)
    assert {r["analysis_method"] for r in B.enrich_batches(df, ["id"]).collect()} == {"rating"}
    bare = B.enrich_batches(df.drop("body"), ["id"], B.rating_scorer())
    assert {r["analysis_method"] for r in bare.collect()} == {"rating"}


def test_rating_scorer_equals_the_rating_rule(spark):
    df = reviews(spark)
    scored = {r["id"]: r["sentiment"] for r in B.enrich_batches(df, ["id"], B.rating_scorer()).collect()}
    assert scored == {r["id"]: r["sentiment"] for r in B.enrich_batches(df, ["id"]).collect()}
