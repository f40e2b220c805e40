"""Substring dedup by winnowed windows, in place of a relative Lempel-Ziv parse.

All documents, in order of their ids, are the reference. Its index holds phrases of six words, those whose digest is
the smallest among the fifteen phrases of some window of twenty words; equal windows choose equal phrases, so a
phrase that occurs once in the whole reference rules out every window that chose it. Each window that is left is
checked against the first place of the same window in the reference. There are no reference blocks and no factors:
duplicate spans are the unions of the windows that have an earlier place.

Nothing is paired. The index and the windows answer only which places are the first, and a document gets the first
places that lie in it; places that are not first are duplicates. So a passage in a third of all documents is one
entry for each task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.llm.common import stage_rows, text_values
from shelfsight.operators.ordering import number_rows
from shelfsight.staging import stage

WINDOW, PHRASE = 20, 6
_CHOICE = WINDOW - PHRASE + 1
#: A place is the rank of the document and, in the lower bits, the number of its word: no text that Spark holds has more.
_WORD_BITS = 30
_RANKS = 1 << 33
#: Stands for the whole document in the place of a word number.
_WHOLE = (1 << _WORD_BITS) - 1
_PIECE = 1 << 16
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _odd_numbers(seed: int, count: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


#: Words of more bytes have a cryptographic digest: sums of powers collide for long words that are built for it, as
#: Thue-Morse words are, whatever the base.
_SHORT = 32
_BYTES = _odd_numbers(1, 256)
_BASE, _MIX, _MIX2 = (int(x) for x in _odd_numbers(2, 3))
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of a number modulo 2**64, as many as were asked for."""

    def __init__(self, base: int):
        self._base, self._values = np.uint64(base), np.ones(1, dtype=np.uint64)

    def get(self, count: int) -> np.ndarray:
        if count > len(self._values):
            size = max(count, 2 * len(self._values))
            steps = np.full(size, self._base, dtype=np.uint64)
            steps[0] = 1
            self._values = np.cumprod(steps, dtype=np.uint64)
        return self._values[:count]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def _mix(values: np.ndarray, factor: int) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(factor)
    return values ^ (values >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every run of ``width`` values, doubling the run."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def _word_numbers(words: list[bytes]) -> np.ndarray:
    """64 bits for each word."""
    text = np.frombuffer(b" ".join(words), dtype=np.uint8)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[text] * _UP.get(len(text)), out=sums[1:])
    numbers = _mix((sums[ends] - sums[starts]) * _DOWN.get(len(text) + 1)[starts], _MIX)
    for i in np.flatnonzero(sizes > _SHORT):
        numbers[i] = int.from_bytes(blake2b(words[i], digest_size=8).digest(), "little")
    return numbers


class Piece:
    """Digests of a piece of a document: of each phrase, and of the phrase each window chooses."""

    def __init__(self, words: list[bytes]):
        numbers = _word_numbers(words)
        self._sums, self._others = self._added(numbers), self._added(_mix(numbers, _MIX))
        self._down = _DOWN.get(len(words) + 1)
        self.phrases = _mix(self._spans(self._sums, PHRASE), _MIX)
        self.chosen = _sliding(self.phrases, _CHOICE, np.minimum)

    @staticmethod
    def _added(numbers: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(numbers) + 1, dtype=np.uint64)
        np.cumsum(numbers * _UP.get(len(numbers)), out=sums[1:])
        return sums

    def _spans(self, sums: np.ndarray, width: int) -> np.ndarray:
        return (sums[width:] - sums[:-width]) * self._down[: len(sums) - width]

    def anchors(self) -> np.ndarray:
        """Places of the phrases that some window chooses."""
        edge = np.zeros(_CHOICE - 1, dtype=np.uint64)
        return np.flatnonzero(_sliding(np.concatenate([edge, self.chosen, edge]), _CHOICE, np.maximum) == self.phrases)

    def candidates(self, unique: np.ndarray) -> np.ndarray:
        """For each window, whether the phrase it chooses occurs elsewhere; ``unique`` are places of those that don't."""
        alone = np.full(len(self.phrases), _MOST, dtype=np.uint64)
        alone[unique] = self.phrases[unique]
        return _sliding(alone, _CHOICE, np.minimum) != self.chosen

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """96 bits for each window, from two digests of each word."""
        one, two = (_mix(self._spans(sums, WINDOW), _MIX2) for sums in (self._sums, self._others))
        return one.view(np.int64), (two >> np.uint64(33)).astype(np.int32)


def pieces(words: list[bytes]) -> Iterator[tuple[int, Piece]]:
    """Pieces of a document that together hold each of its windows once, with the number of their first word."""
    for start in range(0, len(words) - WINDOW + 1, _PIECE):
        yield start, Piece(words[start:start + _PIECE + WINDOW - 1])


def _within(places: np.ndarray, start: int, count: int) -> np.ndarray:
    """Those of sorted ``places`` in ``[start, start + count)``, counted from ``start``."""
    low, high = np.searchsorted(places, [start, start + count])
    return places[low:high] - start


def _places(value) -> np.ndarray:
    return np.sort(np.array(value if value is not None else [], dtype=np.int64))


def _index_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, more, places = [], [], []
        for rank, text in zip(batch.column(0).to_pylist(), text_values(batch.column(1)), strict=True):
            words = text.split()
            if len(words) < WINDOW:
                continue
            whole = blake2b(b" ".join(words), digest_size=12).digest()
            found = [np.array([_WHOLE])]
            digests.append(np.frombuffer(whole[:8], dtype=np.int64))
            more.append(np.frombuffer(whole[8:], dtype=np.int32) | 1)
            for start, piece in pieces(words):
                anchors = piece.anchors()
                digests.append(piece.phrases[anchors].view(np.int64))
                more.append(np.zeros(len(anchors), dtype=np.int32))
                found.append(anchors + start)
            places.append(np.concatenate(found) + (rank << _WORD_BITS))
        if places:
            yield pa.RecordBatch.from_pydict({
                "digest": np.concatenate(digests), "more": np.concatenate(more), "place": np.concatenate(places),
            })


def _unpack(value: bytes | None) -> list[bytes]:
    return zstandard.decompress(value).split() if value else []


def _window_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rank, packed, alone in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            unique = _places(alone)
            words = _unpack(packed)
            if not len(unique) or unique[-1] != _WHOLE:
                continue
            for start, piece in pieces(words):
                wanted = np.flatnonzero(piece.candidates(_within(unique, start, len(piece.phrases))))
                if len(wanted):
                    digests, more = piece.windows()
                    yield pa.RecordBatch.from_pydict({
                        "digest": digests[wanted], "more": more[wanted], "place": wanted + (rank << _WORD_BITS) + start,
                    })


def factors(words: list[bytes], alone, first) -> list[tuple[int, int]]:
    """Duplicate spans of a document from the places of its lone phrases and of its first windows."""
    if len(words) < WINDOW:
        return []
    unique, firsts = _places(alone), _places(first)
    if not len(unique) or unique[-1] != _WHOLE:
        return [(0, len(words))]
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    for start, piece in pieces(words):
        again = piece.candidates(_within(unique, start, len(piece.phrases)))
        again[_within(firsts, start, len(again))] = False
        at = np.flatnonzero(again) + start
        marks[at] += 1
        marks[at + WINDOW] -= 1
    covered = np.concatenate([[False], np.cumsum(marks[:-1]) > 0, [False]])
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_PARSED = pa.struct([("text", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(_SPAN))])


def _parser():
    @F.arrow_udf("struct<text: binary, n_words: bigint, n_removed: bigint, spans: array<struct<start: bigint, end: bigint>>>")
    def parse(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            rows = []
            for packed, alone, first in zip(*(c.to_pylist() for c in columns), strict=True):
                words = _unpack(packed)
                spans = factors(words, alone, first)
                kept, last = [], 0
                for start, end in spans:
                    kept += words[last:start]
                    last = end
                kept += words[last:]
                rows.append({
                    "text": b" ".join(kept), "n_words": len(words), "n_removed": len(words) - len(kept),
                    "spans": [{"start": a, "end": b} for a, b in spans],
                })
            yield pa.array(rows, _PARSED)

    return parse


@F.arrow_udf(T.BinaryType())
def _packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    packer = zstandard.ZstdCompressor(level=3)
    for texts in batches:
        yield pa.array([packer.compress(t) if t else None for t in text_values(texts)], pa.binary())


def _ranked(df: DataFrame, key: str) -> DataFrame:
    """Add ``_rank``, a number that orders rows by id, null last, and rows of one id by their place.

    An id that is a number of up to 33 bits and never repeats is its own rank.
    """
    if isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        rows, ids, low, high = df.agg(F.count("*"), F.count(key), F.min(key), F.max(key)).first()
        repeats = df.groupBy(key).count().where("count > 1")
        if rows == ids and (not rows or (low >= 0 and high < _RANKS and repeats.isEmpty())):
            return df.withColumn("_rank", F.col(key).cast("long"))
    rows = stage_rows(df, "substring-rows")
    ranks = number_rows(rows.select("_row", key), [F.col(key).isNull(), key, "_row"], "_rank")
    return stage(rows.join(ranks.select("_row", "_rank"), "_row").drop("_row"), "ranked-rows")


def _by_document(places: DataFrame, name: str) -> DataFrame:
    word = F.col("place").bitwiseAND(_WHOLE).cast("int")
    return places.groupBy(F.shiftright("place", _WORD_BITS).alias("_rank")).agg(F.collect_list(word).alias(name))


def substring_dedup(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Replace ``text`` by its words that stay, joined by one space, and add ``n_words, n_removed, spans``.

    A window of twenty words is removed if the same words also start at an earlier place: in a row with a smaller
    id, or earlier in the same row. Null ids come last, and rows that share an id are ordered as they are stored.
    Windows are judged on the input. A null text has no words; texts of fewer than twenty words stay whole. An
    empty table gives no rows. Input columns called like a result column are replaced, names that begin with an
    underscore are reserved. No text that Spark can hold has too many words; it must fit a task's memory as a list of words.
    """
    ranked = _ranked(df, key)
    body = F.col(text).cast("binary")
    entries = ranked.select("_rank", body.alias("body")).mapInArrow(_index_entries, "digest bigint, more int, place bigint")
    counted = entries.groupBy("digest", "more").agg(F.min("place").alias("place"), F.count("*").alias("n"))
    lone = counted.where((F.col("n") == 1) | (F.col("place").bitwiseAND(_WHOLE) == _WHOLE)).select("place")
    alone = stage(_by_document(lone, "_alone"), "lone-phrases")
    packed = ranked.select("_rank", _packed(body).alias("_body"))
    windows = packed.join(alone, "_rank").mapInArrow(_window_entries, "digest bigint, more int, place bigint")
    first = windows.groupBy("digest", "more").agg(F.min("place").alias("place")).select("place")
    answers = alone.join(_by_document(first, "_first"), "_rank", "left")
    parsed = ranked.withColumn(text, _packed(body)).join(answers, "_rank", "left").withColumn("_parsed", _parser()(F.col(text), F.col("_alone"), F.col("_first")))
    return parsed.withColumns({
        text: F.col("_parsed.text").cast("string"), "n_words": F.col("_parsed.n_words"),
        "n_removed": F.col("_parsed.n_removed"), "spans": F.col("_parsed.spans"),
    }).drop("_rank", "_alone", "_first", "_parsed")
