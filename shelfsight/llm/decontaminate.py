"""Benchmark decontamination by multi-pattern search over words.

The windows of all benchmark items are the patterns. For each pattern length a table says how far the search may
skip after a pair of words, pairs that end a pattern lead to a bucket, the bucket is narrowed by the pattern's
first words, and a direct comparison confirms the occurrence. Most words of a clean document are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.common import stage_rows, text_values

WINDOW = 13
#: Benchmark words whose windows are held in a worker at once; a larger benchmark is searched in several passes.
BLOCK_WORDS = 100_000

_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c in _LETTERS else 0x20 for c in range(256)
)
_HITS = "struct<n_words: bigint, spans: array<struct<start: bigint, end: bigint>>, items: array<string>>"


def folded_words(text: bytes) -> list[bytes]:
    """Words of letters, digits and all characters beyond ASCII, with A-Z in lower case."""
    return text.translate(_FOLD).split()


@dataclass
class _Length:
    """Search tables for the patterns of one length."""

    length: int
    block: int
    shift: dict[tuple, int] = field(default_factory=dict)
    buckets: dict[tuple, dict[tuple, list[tuple[list[bytes], list[int]]]]] = field(default_factory=dict)

    def add(self, words: tuple[bytes, ...], items: list[int]) -> None:
        for end in range(self.block, self.length + 1):
            piece = words[end - self.block:end]
            self.shift[piece] = min(self.shift.get(piece, self.length), self.length - end)
        bucket = self.buckets.setdefault(words[-self.block:], {})
        bucket.setdefault(words[:self.block], []).append((list(words), items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Start and items of each occurrence, in order."""
        size, block, shift = self.length, self.block, self.shift
        farthest = size - block + 1
        last, end = size, len(words)
        while last <= end:
            skip = shift.get(tuple(words[last - block:last]), farthest)
            if skip:
                last += skip
                continue
            start = last - size
            narrowed = self.buckets[tuple(words[last - block:last])].get(tuple(words[start:start + block]), ())
            for pattern, items in narrowed:
                if pattern == words[start:last]:
                    yield start, items
            last += 1


def build_tables(items: list[tuple[str, bytes]], window: int = WINDOW) -> tuple[list[_Length], list[str]]:
    """Search tables by pattern length, and the names of the items."""
    names = sorted({name for name, _ in items})
    place = {name: i for i, name in enumerate(names)}
    owners: dict[tuple[bytes, ...], set[int]] = {}
    for name, text in items:
        words = folded_words(text)
        for start in range(max(1, len(words) - window + 1) if words else 0):
            owners.setdefault(tuple(words[start:start + window]), set()).add(place[name])
    lengths: dict[int, _Length] = {}
    for words, found in owners.items():
        size = len(words)
        lengths.setdefault(size, _Length(size, min(2, size))).add(words, sorted(found))
    return list(lengths.values()), names


def find_hits(words: list[bytes], tables: list[_Length]) -> tuple[list[list[int]], set[int]]:
    """Merged word spans that occurrences cover, and the items that occur."""
    found: list[tuple[int, int]] = []
    items: set[int] = set()
    for table in tables:
        for start, owners in table.search(words):
            found.append((start, start + table.length))
            items.update(owners)
    spans: list[list[int]] = []
    for start, end in sorted(found):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    return spans, items


def _searcher(tables) -> Callable[[Column], Column]:
    """``tables`` is a broadcast pair of search tables and item names."""

    @F.arrow_udf(_HITS)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lengths, names = tables.value
        for texts in batches:
            rows = []
            for text in text_values(texts):
                words = folded_words(text)
                spans, items = find_hits(words, lengths)
                rows.append({
                    "n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans],
                    "items": sorted(names[i] for i in items),
                })
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.array(rows, pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))]))

    return search


def _blocks(benchmark: DataFrame, text: str, item: str, window: int, block_words: int) -> list:
    """Broadcast search tables, each over a bounded part of the benchmark."""
    spark = benchmark.sparkSession
    words = F.size(F.split(F.coalesce(F.col(text), F.lit("")), r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    texts = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.encode(text, "UTF-8").alias("text"), words.alias("words"))
    total = texts.agg(F.sum("words")).first()[0] or 0
    parts = -(-total // block_words) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    out = []
    for number in range(parts):
        rows = [(r[0], bytes(r[1] or b"")) for r in texts.where(part == number).select("item", "text").collect()]
        out.append(spark.sparkContext.broadcast(build_tables(rows, window)))
    return out


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", benchmark_text: str = "text",
                  item: str = "item_id", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add ``n_words, n_hit, n_items, items, spans, contaminated`` to every row.

    ``spans`` are the merged word spans covered by windows of the benchmark. A row is contaminated if they hold
    at least a twentieth of its words. A null or empty text has no words and no hits. Repeated items count
    once by name, and an item without a name is called ''. An empty benchmark hits nothing, an empty table
    gives no rows. Input columns called like a result column are replaced, names that
    begin with an underscore are reserved.

    A benchmark of up to ``block_words`` words is searched in one pass over the documents. A larger one is
    searched block by block, each of bounded size, and the hits of a document are put together.
    """
    blocks = _blocks(benchmark, benchmark_text, item, window, block_words)
    body = F.col(text).cast("binary")
    if len(blocks) == 1:
        out = df.withColumn("_hits", _searcher(blocks[0])(body))
    else:
        rows = stage_rows(df, "contaminated-rows")
        passes = [rows.select("_row", _searcher(b)(body).alias("h")).select("_row", "h.*") for b in blocks]
        union = passes[0]
        for other in passes[1:]:
            union = union.unionByName(other)
        merged = union.groupBy("_row").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        hits = F.struct("n_words", _merged(F.array_sort("spans")).alias("spans"), "items")
        out = rows.join(merged.select("_row", hits.alias("_hits")), "_row").drop("_row")
    covered = F.aggregate("_hits.spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return (
        out.withColumns({
            "n_words": F.col("_hits.n_words"), "n_hit": covered,
            "n_items": F.size("_hits.items").cast("long"), "items": F.col("_hits.items"), "spans": F.col("_hits.spans"),
        })
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .drop("_hits")
    )


def _merged(spans: Column) -> Column:
    """Join sorted spans that overlap or touch."""
    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))
        meets = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"])
        return F.when(meets, joined).otherwise(F.concat(done, F.array(span)))

    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return F.aggregate(spans, empty, add)
