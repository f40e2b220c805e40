"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, size int, target string, kept string, score string, "
    "n_words string, spans string, fp string, signature string, log_weight string, n_lines string"
)
LONG = "long words go on and on " * 20_000
CLASH = (1, "t", "k", "s", "w", "p", "f", "g", "l", "n")


def hostile(spark):
    rows = [
        (1, "the same text here", "en", "a"), (2, "the  same\ttext here", "en", "b"), (3, None, "en", "a"), (4, "", None, None),
        (5, " \n\t ", "fr", "b"), (6, LONG, "en", "a"), (7, LONG, "en", None), (8, "ä ö ü 日本語", "de", "c"), (9, "12345 $$$", "de", "c"),
        (None, "the same text here", "en", "a"), (10, "repeated row of text", "en", "b"), (10, "repeated row of text", "en", "b"),
        (11, None, None, None),
    ]
    return spark.createDataFrame([r + CLASH for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
