"""Token counts without a shuffle of texts.

A text is cut at single spaces and line breaks into pre-tokens that no piece of the vocabulary spans, so the
tokens of a text are the sum over its pre-tokens. The lengths of the pre-tokens that are most frequent in all texts
are broadcast as one compact table; each worker encodes what the table misses once and remembers it in a bounded cache.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.operators.ordering import number_rows
from shelfsight.staging import staged_until_done

#: Pre-tokens in the broadcast table. It speeds up counting, no count depends on it.
TABLE_SIZE = 65_536
_CACHE_SIZE = 500_000
_CACHED_LENGTH = 48
#: How the library writes a space.
_SPACE = "▁"


def load(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def pre_tokens(text: str) -> list[str] | None:
    """Pre-tokens of a text; those after a line break begin with it. None if the text has runs of spaces."""
    spaced = text.replace("\n", " \n")
    if _SPACE in spaced or "  " in spaced or spaced[:1] == " " or spaced[-1:] == " ":
        return None
    return spaced.split(" ")


class Lengths(dict):
    """Tokens of each pre-token: the broadcast table, then what this worker has met."""

    def __init__(self, processor, frequent: dict[str, int]):
        super().__init__(frequent)
        self._processor, self._frequent = processor, frequent

    def __missing__(self, piece: str) -> int:
        # The library puts a space first; after a line break there is none.
        length = len(self._processor.encode(piece)) - (piece[:1] == "\n")
        if len(piece) <= _CACHED_LENGTH:
            if len(self) >= _CACHE_SIZE:
                self.clear()
                self.update(self._frequent)
            self[piece] = length
        return length

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = pre_tokens(text)
        if pieces is not None:
            return sum(map(self.__getitem__, pieces))
        first, *others = text.split("\n")
        encode = self._processor.encode
        return len(encode(first)) + (not first and bool(others)) + sum(len(encode("\n" + line)) - 1 for line in others)


def frequent_pre_tokens(df: DataFrame, text: str, size: int = TABLE_SIZE) -> list[str]:
    """The ``size`` most frequent pre-tokens of all rows, the most frequent first and ties by code point.

    Tasks hand over the sums of what they have met, in between too if they hold very many, so each occurrence is counted.
    The sums are shuffled by pre-token, and only the first ``size`` reach the driver. Pre-tokens too long for the cache,
    and texts that are not cut into any, are never looked up and not counted.
    """

    def sums(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"piece": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                seen.update(p for p in pre_tokens(value or "") or () if len(p) <= _CACHED_LENGTH)
                if len(seen) >= _CACHE_SIZE:
                    yield sums(seen)
                    seen.clear()
        yield sums(seen)

    counted = df.select(text).mapInArrow(count, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    with staged_until_done(df.sparkSession):
        ranked = number_rows(counted, [F.desc("n"), F.col("piece")], "_rank").where(F.col("_rank") < size)
        return [r["piece"] for r in ranked.orderBy("_rank").collect()]


def token_counts(df: DataFrame, model: bytes, text: str = "text", limit: int = 4096) -> DataFrame:
    """Add ``n_bytes, n_tokens, over_limit``; ``model`` is the content of the library's model file.

    Null and empty texts have 0 bytes and 0 tokens. Texts of any length are counted whole; those with runs of
    spaces are encoded line by line by the library itself. An empty table gives no rows; input columns called
    like a result column are replaced, names that begin with an underscore are reserved.
    """
    context = df.sparkSession.sparkContext
    pieces = [p for p in frequent_pre_tokens(df, text) if " " not in p]
    encode = Lengths(load(model), {})
    table = context.broadcast((model, " ".join(pieces), bytes(min(encode[p], 255) for p in pieces)))

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        content, names, sizes = table.value
        frequent = {p: n for p, n in zip(names.split(" "), sizes, strict=False) if n < 255}
        lengths = Lengths(load(content), frequent)
        for texts in batches:
            yield pa.array([lengths.count(t) for t in texts.to_pylist()], pa.int64())

    return df.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "n_tokens": count(F.col(text)),
    }).withColumn("over_limit", F.col("n_tokens") > limit)
