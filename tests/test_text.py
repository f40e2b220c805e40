import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfsight.functions import text as X


def test_short_title_always_has_an_ellipsis(column):
    assert column(["abc", "x" * 40, None], X.short_title(F.col("v"))) == ["abc...", "x" * 30 + "...", None]


def test_parse_list(column):
    texts = ['["a","b"]', "['a','b']", '["don\'t"]', "[]", '{"a":1}', '"s"', '[1,"x",null]', "not json", None,
             '["a"] tail', '["a"],["b"]', ' \n["a"]\t', "['it\"s']", "[[1],2]"]
    got = column(texts, X.parse_list(F.col("v")))
    assert got[:11] == [["a", "b"], ["a", "b"], ["don't"], [], [], [], ["1", "x", None], [], [], [], []]
    assert got[11] == ["a"]
    assert got[12] == ['it"s']
    assert got[13] == ["[1]", "2"]


def test_single_json_value(column):
    texts = ['{"a":1}', '{"a":1},', '{"a":1} {"b":2}', '{"a":1}\n{"b":2}', "[1, 2]", "[1,", "12", '"s"', "", None,
             '{"a":1}] x', '{"a":1}} x', "{'a':1}", '{"a":[{"b":1}]}', '{"error":null}', "junk"]
    expected = ['{"a":1}', None, None, None, "[1,2]", None, "12", "s", None, None,
                None, None, None, '{"a":[{"b":1}]}', '{"error":null}', None]
    assert column(texts, X.single_json_value(F.col("v"))) == expected


def test_single_json_value_agrees_with_a_strict_parser(column):
    alphabet = '{}[]",:1a \n'

    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.text(alphabet=alphabet, min_size=1, max_size=8), min_size=400, max_size=400))
    def check(texts):
        texts = [t.strip() for t in texts]

        def valid(t):
            try:
                return json.loads(t) is not None
            except ValueError:
                return False
        got = column(texts, X.single_json_value(F.col("v")))
        assert [g is not None for g in got] == [valid(t) for t in texts]
    check()


def test_render_item_truncates_the_text(spark):
    df = spark.createDataFrame([(1, 4.0, "x" * 600), (2, None, None)], "p int, r double, t string")
    got = [r[0] for r in df.select(X.render_item(F.col("p"), F.col("r"), F.col("t"))).collect()]
    assert got == ["\n[Review 1] (Rating: 4.0/5)\n" + "x" * 500 + "\n", "\n[Review 2] (Rating: N/A/5)\n\n"]


def test_strip_code_fence(column):
    texts = ["[1]", "```json\n[1]\n```", "```\n[1]\n```\nDone.", "  ```json\n[1]```  ", "a ``` b", None]
    assert column(texts, X.strip_code_fence(F.col("v"))) == ["[1]", "[1]", "[1]", "[1]", "a ``` b", None]


def test_parse_response(column):
    texts = ['[{"index":1,"sentiment":"Positive","issues":["i"],"themes":[],"summary":"s"}]',
             '{"index":2,"sentiment":"Negative"}', "[]", "{}", "", "junk", '[{"index":"x"}]', '[{"index":1.0}]', None,
             '[{"index":1}] tail']
    got = column(texts, X.parse_response(F.col("v")))
    assert got[0][0].asDict() == {"index": 1, "sentiment": "Positive", "issues": ["i"], "themes": [], "summary": "s"}
    assert [a["sentiment"] for a in got[1]] == ["Negative"]
    assert got[2:6] == [None] * 4
    assert got[6][0]["index"] is None
    assert len(got[7]) == 1
    assert got[8] is None and got[9] is None


def test_summary_line(spark):
    df = spark.createDataFrame([(2.0, "bad", ["a", "b"]), (5.0, "ok", [])], "r double, s string, i array<string>")
    got = [r[0] for r in df.select(X.summary_line(F.col("r"), F.col("s"), F.col("i"))).collect()]
    assert got == ["2.0/5 -- bad | Issues: a, b", "5.0/5 -- ok"]


def test_formats(column):
    assert column([3.14159, None], X.format_price(F.col("v")), "double") == ["$3.14", None]
    assert column([4.25], X.format_rating(F.col("v")), "double") == ["4.2 / 5.0"]
    assert column([12.34, float("-inf")], X.format_percent(F.col("v")), "double") == ["12.3%", "-inf%"]


def test_formats_round_the_exact_value(column):
    values = [n / 1000 for n in range(-3000, 3001)] + [n / 8 for n in range(100)] + [1e15, 123456.785, 2.675]
    assert column(values, X.format_percent(F.col("v")), "double") == [f"{v:.1f}%" for v in values]
    assert column(values, X.format_price(F.col("v")), "double") == [f"${v:.2f}" for v in values]
