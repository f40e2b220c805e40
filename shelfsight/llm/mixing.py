"""Mixing sources to target weights.

Targets follow from capped water-filling: every source gets its weighted part of all words, a source that would
need more than ``max_epochs`` repetitions is clamped to them, and what it cannot take is shared out again by
weight until no source is above its cap. Whole repetitions take every document; the fractional one takes
documents in the order of a seeded digest of their id until its words are reached.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.llm.common import WORD, join_counted, key_text
from shelfsight.operators.ordering import number_rows
from shelfsight.staging import stage

#: The place of a document in its source's order is a number of 36 bits, searched 12 bits at a time.
_DIGITS, _STEP = 9, 12


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _place(*columns: str, seed: int) -> Column:
    """36 bits of a seeded digest of some columns."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat(*texts, F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] | DataFrame, max_epochs: int) -> DataFrame:
    """Targets of stored sources ``(_source, source_size, _weight)`` by capped water-filling.

    Only two sums reach the driver in each round: the words of the clamped sources and the weights of the
    others. Each round clamps further sources or ends.
    """
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    weight = sizes.agg(F.sum("_weight")).first()[0] or 0
    cap = F.col("source_size") * max_epochs
    clamped_words, open_weight = 0, weight
    while True:
        above = F.col("_weight") * F.lit(total - clamped_words) > cap * F.lit(open_weight)
        words, left = sizes.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0))
        ).first()
        if (words, left) == (clamped_words, open_weight):
            break
        clamped_words, open_weight = words, left
    share = (F.col("_weight") * F.lit(total - clamped_words)).cast("double") / F.lit(max(open_weight, 1))
    return sizes.withColumn("target", F.when(above, cap.cast("double")).otherwise(share))


def mix(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
        weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: int = 7) -> DataFrame:
    """Add ``size, source_size, target, repeats, taken`` to every row.

    The sources, by code point with null last, take ``weights`` in turn, repeating. ``repeats`` is how often the
    mix holds the document (0: it is left out) and ``taken`` is ``size * repeats``. Null and empty texts have size
    0 and take nothing from a target. Null sources form one source. Rows with the same id, or without one, are ordered
    by a digest of their texts; only rows that also have the same text are taken or left together. An empty table gives
    no rows. Input columns called like a result column are replaced, names that begin with an underscore are reserved.
    The same rows and seed give the same mix.
    """
    row = df.withColumns({
        "size": word_count(text), "_source": key_text(source), "_place": _place(key, seed=seed),
        "_again": _place(key, text, seed=seed),
    })
    narrow = stage(row.select("_source", "size", "_place", "_again"), "mix-sizes")
    sizes = narrow.groupBy("_source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(sizes, [F.col("_source") == "", F.col("_source")], "_rank")
    by_rank = F.element_at(F.lit(list(weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = stage(ranked.select("_source", "source_size", by_rank.cast("long").alias("_weight")), "mix-sources")
    targets = source_targets(sources, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("_whole", whole).withColumn(
        "_rest", F.col("target") - F.col("_whole") * F.col("source_size")
    )
    plan = stage(_last_places(narrow, stage(targets, "mix-targets")), "mix-plan")
    taken = (F.col("_place") < F.col("_last")) | ((F.col("_place") == F.col("_last")) & (F.col("_again") <= F.col("_last_again")))
    repeats = F.col("_whole") + F.when(taken, 1).otherwise(0)
    joined = join_counted(row.drop("source_size", "target"), plan.drop("_rest", "_weight"), "_source", F.col(key))
    return (
        joined.withColumn("repeats", repeats)
        .withColumn("taken", F.col("size") * F.col("repeats"))
        .drop("_source", "_place", "_again", "_whole", "_last", "_last_again")
    )


def _crossing(narrow: DataFrame, wanted: DataFrame, place: str) -> DataFrame:
    """``_source, _cell, _before, _rest, _words``: the place at which a source's running sum passes ``_rest``.

    ``wanted`` is a stored table of ``_source, _before, _rest``; ``_before`` are the words before all of ``narrow``. The
    places are searched in steps of 12 bits: words are summed by the next bits, and the cell in which the running sum
    passes the wanted words is opened further. So a source of any size hands at most 4096 sums to a window.
    """
    bits = 4 * _DIGITS
    state = wanted.withColumn("_cell", F.lit(0).cast("long"))
    for depth in range(_STEP, bits + 1, _STEP):
        inside = join_counted(narrow, state.select("_source", F.col("_cell").alias("_in"), "_before", "_rest"),
                              "_source", F.col(place), "inner")
        inside = inside.where(F.shiftright(place, bits - depth + _STEP) == F.col("_in"))
        cells = inside.groupBy("_source", "_before", "_rest", F.shiftright(place, bits - depth).alias("_cell")).agg(
            F.sum("size").alias("_words")
        )
        earlier = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        placed = cells.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
        crossing = placed.where((F.col("_before") < F.col("_rest")) & (F.col("_rest") <= F.col("_before") + F.col("_words")))
        state = stage(crossing.select("_source", "_cell", "_before", "_rest", "_words"), "mix-cells")
    return state


def _last_places(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """Add ``_last`` and ``_last_again``, the last place that the fractional repetition of each source takes.

    The rows at the place that crosses, as a rule one document, are ordered by ``_again`` and searched alike. The last
    of them is taken if at least half of it is wanted.
    """
    first = _crossing(narrow, stage(targets.select("_source", F.lit(0).cast("long").alias("_before"), "_rest"), "mix-wanted"), "_place")
    at = join_counted(narrow, first.select("_source", F.col("_cell").alias("_at")), "_source", F.col("_place"), "inner")
    there = stage(at.where(F.col("_place") == F.col("_at")).select("_source", "size", "_again"), "mix-crossed")
    second = _crossing(there, first.select("_source", "_before", "_rest"), "_again")
    taken = F.col("_before") + F.col("_words") / 2 <= F.col("_rest")
    last = second.select("_source", (F.col("_cell") - F.when(taken, 0).otherwise(1)).alias("_last_again"))
    found = first.select("_source", F.col("_cell").alias("_last")).join(last, "_source", "left")
    none = F.lit(-1).cast("long")
    return targets.join(found, "_source", "left").withColumns({
        "_last": F.coalesce("_last", none), "_last_again": F.coalesce("_last_again", none),
    })
