"""Titles, list text, analyser prompts and analyser responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfsight.functions.numbers import round_exact

_STRICT = {"allowSingleQuotes": "false"}
_FENCE = "```"

RESPONSE_SCHEMA = (
    "array<struct<index:int,sentiment:string,issues:array<string>,themes:array<string>,summary:string>>"
)


def short_title(col: Column, length: int = 30) -> Column:
    """The first characters of a title, always followed by an ellipsis."""
    return F.concat(F.substring(col, 1, length), F.lit("..."))


def strip(col: Column) -> Column:
    """Remove JSON white space at both ends."""
    return F.btrim(col, F.lit(" \t\r\n"))


def _let(col: Column, use: Callable[[Column], Column]) -> Column:
    """``use(col)``, where ``use`` may name its argument often and it is still computed once."""
    return F.get(F.transform(F.array(col), use), 0)


def _keep_if(col: Column, test: Callable[[Column], Column]) -> Column:
    """The value if it passes the test, else null; it is computed once."""
    return F.get(F.filter(F.array(col), test), 0)


def _only_element(array: Column) -> Column:
    """The element of an array of one, else null."""
    return F.get(_keep_if(array, lambda a: F.size(a) == 1), 0)


def single_json_value(text: Column) -> Column:
    """The text of a JSON value if ``text`` is exactly one, else null.

    The JSON functions ignore whatever follows a complete value. Text that is valid both as the only
    element of an array and as the only field of an object has nothing behind its value. Text without a
    closing bracket cannot have ended the array early, so one check is enough for it.
    """
    def value(t: Column) -> Column:
        element = F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>", _STRICT)
        field = F.from_json(F.concat(F.lit('{"v":'), t, F.lit("}")), "v string", _STRICT)["v"]
        return F.when(~t.contains("]") | field.isNotNull(), _only_element(element))
    return _let(text, value)


def parse_list(col: Column) -> Column:
    """List text to an array: JSON first, then with quotes swapped, else empty.

    Text that does not look like a list is not parsed: failing is the slowest thing a parser does. Nor is
    an empty list, which is the most frequent one.
    """
    empty = F.array().cast("array<string>")

    def attempt(text: Column) -> Column:
        bare = strip(text)
        wrapped = F.when(
            bare.startswith("[") & bare.endswith("]"), F.concat(F.lit("["), bare, F.lit("]"))
        )
        return _only_element(F.from_json(wrapped, "array<array<string>>"))

    swapped = F.replace(col, F.lit("'"), F.lit('"'))
    return F.when(col.isNull() | (col == "[]"), empty).otherwise(
        F.coalesce(attempt(col), F.when(col.contains("'"), attempt(swapped)), empty)
    )


def truncate_text(col: Column, length: int = 500) -> Column:
    """The part of a review that is shown to the analyser."""
    return F.substring(col, 1, length)


def render_item(position: Column, rating: Column, text: Column) -> Column:
    """One review as it appears in an analyser prompt; positions start at 1."""
    return F.concat(
        F.lit("\n[Review "), position.cast("string"),
        F.lit("] (Rating: "), F.coalesce(rating.cast("string"), F.lit("N/A")), F.lit("/5)\n"),
        F.coalesce(truncate_text(text), F.lit("")), F.lit("\n"),
    )


def strip_code_fence(col: Column) -> Column:
    """Remove a code fence around a response, and anything after its closing line."""
    def inner(text: Column) -> Column:
        opened = F.regexp_replace(text, rf"^{_FENCE}[^\n]*\n", "")
        closed = F.regexp_replace(opened, rf"(?s)\s*{_FENCE}(?!.*{_FENCE}).*$", "")
        return F.when(text.startswith(_FENCE), closed).otherwise(text)
    return _let(strip(col), inner)


def parse_response(col: Column) -> Column:
    """Response text to an array of answers; null when it is empty or not a JSON value."""
    value = single_json_value(strip_code_fence(col))
    parsed = F.from_json(_keep_if(value, lambda v: ~v.rlike(r"^\{\s*\}$")), RESPONSE_SCHEMA)
    return _keep_if(parsed, lambda answers: F.size(answers) > 0)


def issue_suffix(issues: Column) -> Column:
    """`` | Issues: a, b`` for a non-empty list, else an empty text."""
    listed = _let(issues, lambda i: F.when(
        F.size(i) > 0, F.concat(F.lit(" | Issues: "), F.array_join(i, ", "))
    ))
    return F.coalesce(listed, F.lit(""))


def summary_line(rating: Column, summary: Column, issues: Column) -> Column:
    """One line of the summary list: rating, summary and issues."""
    return F.concat(
        F.coalesce(rating.cast("string"), F.lit("N/A")), F.lit("/5 -- "),
        F.coalesce(summary, F.lit("")), issue_suffix(issues),
    )


def _format(pattern: str, col: Column, digits: int) -> Column:
    text = F.format_string(pattern, round_exact(col, digits))
    return F.when(col.isNotNull(), F.replace(text, F.lit("Infinity"), F.lit("inf")))


def format_price(col: Column) -> Column:
    return _format("$%.2f", col, 2)


def format_rating(col: Column) -> Column:
    return _format("%.1f / 5.0", col, 1)


def format_percent(col: Column) -> Column:
    return _format("%.1f%%", col, 1)
