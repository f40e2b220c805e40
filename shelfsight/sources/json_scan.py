"""Records of JSON arrays that are too large for one task, cut where the brackets say.

A split of a file does not know whether it begins inside a string, or how deep. So each split first answers for all
cases: where a reader leaves it who enters it outside a string, inside one, or behind a backslash, which brackets it
closes and which it leaves open. These answers are composed along each file, one row per split, which gives every split
its true beginning; then the splits are cut into records side by side. What begins in one split and ends in another is
put together last.

Tasks read a file in pieces that end at closing braces, which is where records can end, so no task holds a file, and
none a split either.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.staging import stage

OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
_STRING = re.compile(rb'"(?:[^"\\]|\\.)*"', re.S)
_IN_STRING = re.compile(rb'(?:[^"\\]|\\.)*', re.S)
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*"|[\[\]{"]', re.S)
_OTHERS = bytes(b for b in range(256) if b not in b"[]{")
#: What may stand before a document: white space and a byte order mark.
_BLANK = b" \t\r\n\xef\xbb\xbf"

_ANSWERS = "file string, split bigint, bytes bigint, first string, states array<int>, closes array<int>, opens array<string>"
_STARTS = "file string, split bigint, state int, depth int, offset bigint, outer int, inside boolean"
_PARTS = pa.schema([
    ("file", pa.string()), ("place", pa.int64()), ("begins", pa.bool_()), ("ends", pa.bool_()), ("text", pa.binary()),
])


def _string_end(text: bytes, state: int) -> tuple[int, int]:
    """How far the string that is open at the beginning of ``text`` goes, and the state behind that."""
    if not text:
        return 0, state
    end = _IN_STRING.match(text, 1 if state == ESCAPED else 0).end()
    if end == len(text):
        return end, INSIDE
    # What stops the pattern is the closing quote, or a backslash with nothing behind it.
    return (end + 1, OUTSIDE) if text[end:end + 1] == b'"' else (len(text), ESCAPED)


def _passed(text: bytes, state: int) -> tuple[int, bytes]:
    """The state behind a piece of text, and the brackets in it that are not in strings."""
    at = 0
    if state != OUTSIDE:
        at, state = _string_end(text, state)
        if state != OUTSIDE:
            return state, b""
    text = text[at:]
    if b'"' in text:
        text = _STRING.sub(b"", text)
        opened = text.find(b'"')
        if opened >= 0:
            state = _string_end(text[opened + 1:], INSIDE)[1]
            text = text[:opened]
    return state, text.translate(None, _OTHERS)


def _after_brace(state: int) -> int:
    """The state behind the closing brace that ends a piece."""
    return OUTSIDE if state == OUTSIDE else INSIDE


@dataclass
class _Way:
    """Where a reader is who entered a split in one of the three states: what is closed of the outside, what is open."""

    state: int
    closes: int = 0
    opens: list[str] = field(default_factory=list)

    def brackets(self, found: bytes) -> None:
        for b in found:
            if b in b"[{":
                self.opens.append(chr(b))
            elif self.opens:
                self.opens.pop()
            else:
                self.closes += 1


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("file_size"), F.col("value").cast("binary").alias("piece"),
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: its bytes, the first of them that counts, and where each of the three ways leads."""
    at, size, first, ways = None, 0, None, []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([size], pa.int64()), pa.array([first], pa.string()),
            pa.array([[w.state for w in ways]], pa.list_(pa.int32())), pa.array([[w.closes for w in ways]], pa.list_(pa.int32())),
            pa.array([["".join(w.opens) for w in ways]], pa.list_(pa.string())),
        ], ["file", "split", "bytes", "first", "states", "closes", "opens"])

    for file, split, _, piece in _rows(batches):
        if (file, split) != at:
            if at is not None:
                yield row()
            at, size, first, ways = (file, split), 0, None, [_Way(s) for s in (OUTSIDE, INSIDE, ESCAPED)]
        if first is None:
            bare = piece.strip(_BLANK)
            first = chr(bare[0]) if bare else None
        size += len(piece) + 1
        passed = {state: _passed(piece, state) for state in {w.state for w in ways}}
        for way in ways:
            state, brackets = passed[way.state]
            way.brackets(brackets + (b"]" if state == OUTSIDE else b""))
            way.state = _after_brace(state)
    if at is not None:
        yield row()


def _starts(splits):
    """What is true where each split of one file begins. There is a row per split, whatever the file's size."""
    import pandas as pd

    splits = splits.sort_values("split", ignore_index=True)
    top = next((f for f in splits["first"] if f is not None), None)
    outer = 1 if top == "[" else 0
    state, offset, open_, rows = OUTSIDE, 0, [], []
    for x in splits.itertuples():
        inside = len(open_) > outer and open_[outer] == "{"
        rows.append((x.file, x.split, state, len(open_), offset, outer, inside))
        open_ = [*open_[:max(0, len(open_) - x.closes[state])], *x.opens[state]]
        state, offset = int(x.states[state]), offset + x.bytes
    return pd.DataFrame(rows, columns=["file", "split", "state", "depth", "offset", "outer", "inside"])


def _to_record(piece: bytes, state: int, depth: int, outer: int) -> tuple[int, int, int | None]:
    """Pass a piece that begins outside of records: state and depth behind it, and where a record begins in it, if one does."""
    at = 0
    if state != OUTSIDE:
        at, state = _string_end(piece, state)
        if state != OUTSIDE:
            return state, depth, None
    for token in _TOKEN.finditer(piece, at):
        sign = token.group()
        if sign == b"{" and depth == outer:
            state, brackets = _passed(piece[token.start():], OUTSIDE)
            return state, depth + _deeper(brackets), token.start()
        if sign == b'"':
            return _string_end(piece[token.end():], INSIDE)[1], depth, None
        depth += _deeper(sign) if len(sign) == 1 else 0
    return OUTSIDE, depth, None


def _deeper(brackets: bytes) -> int:
    return len(brackets) - 2 * brackets.count(b"]")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records with their place, and the parts of records that begin or end in another split, in file order."""
    at, parts, found, held = None, [], [], 0
    state = depth = offset = outer = place = 0
    inside = begins = False

    def close(ends: bool) -> None:
        if parts:
            found.append((at[0], place, begins, ends, b"".join(parts)))
            parts.clear()

    def batch() -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * len(_PARTS)
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARTS, strict=True)], schema=_PARTS)

    for file, split, file_size, piece, *start in _rows(batches):
        if (file, split) != at:
            close(False)
            if start[0] is None:
                raise ValueError(f"{file} was split otherwise a moment ago: read it with a steady number of cores")
            at = (file, split)
            state, depth, offset, outer, inside = start
            begins, place = False, offset
        if inside:
            parts.append(piece)
            state, brackets = _passed(piece, state)
            depth += _deeper(brackets)
        else:
            state, depth, record = _to_record(piece, state, depth, outer)
            if record is not None:
                inside = begins = True
                place = offset + record
                parts.append(piece[record:])
        # The last piece of a file that does not end at a brace has none behind it.
        if offset + len(piece) < file_size:
            if inside:
                parts.append(b"}")
            depth -= state == OUTSIDE
            if inside and state == OUTSIDE and depth <= outer:
                close(True)
                inside = False
            state = _after_brace(state)
        offset += len(piece) + 1
        held += len(piece)
        if held > 1 << 24:
            yield batch()
            held = 0
    close(False)
    yield batch()


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """The objects of files that hold one JSON array each, of any size, as ``(file, seq, raw)``.

    ``seq`` is where the object begins, in bytes from the beginning of its file. Elements that are no objects are passed
    over, also arrays and what is in them. Files of objects one after the other, on lines or not, are read as well. A file
    that breaks off gives its complete objects. What is cut out is not checked here to be valid JSON.
    """
    pieces = _pieces(spark, path)
    answers = stage(pieces.mapInArrow(_answers, _ANSWERS), "json-splits")
    starts = stage(answers.groupBy("file").applyInPandas(_starts, _STARTS), "json-starts")
    # One row per split of the input: there are as many as tasks.
    known = pieces.join(F.broadcast(starts), ["file", "split"], "left").select(
        "file", "split", "file_size", "piece", "state", "depth", "offset", "outer", "inside"
    )
    parts = known.mapInArrow(_cut, "file string, place bigint, begins boolean, ends boolean, text binary")
    parts = stage(parts, "json-parts")
    whole = parts.where("begins AND ends").select("file", F.col("place").alias("seq"), F.col("text").cast("string").alias("raw"))
    # Of each split at most the first and the last part are not whole; a part that begins a record opens a new number.
    rest = parts.where("NOT (begins AND ends)").withColumn(
        "record", F.expr("sum(cast(begins AS int)) OVER (PARTITION BY file ORDER BY place)")
    )
    joined = rest.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("place", "text"))).alias("parts"), F.min("place").alias("seq"),
        F.bool_or("begins").alias("begins"), F.bool_or("ends").alias("ends"),
    ).where("begins AND ends")
    text = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["text"]))
    return whole.unionByName(joined.select("file", "seq", text.cast("string").alias("raw")))
