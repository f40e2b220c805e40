"""Near-dedup by SimHash with pigeonring filtering.

Fingerprints of 64 bits are cut into four segments on a ring. If two of them differ in at most three bits, some
chain of consecutive segments begins with equal segments and keeps, at each length ``l``, within ``3 * l / 4``
differing bits: 0, then 1, then 2, then 3. Candidates share a chain of two segments within that budget. A chain
that very many fingerprints share is lengthened by the next segment, up to the whole ring, where a candidate is
the fingerprint itself. So no bucket is ever paired off, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.common import spread, stage_rows, text_values
from shelfsight.staging import stage

RADIUS, SEGMENTS, WIDTH = 3, 4, 16
#: Fingerprints of one chain that are compared directly; a longer list has its chain lengthened instead.
CHAIN_LIMIT = 32
_CHUNK = 1 << 18


def shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of ``size`` words, repeats included, in bounded pieces."""
    if words and len(words) < size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], dtype=np.uint64)
        return
    for start in range(0, len(words) - size + 1, _CHUNK):
        part = words[start:start + _CHUNK + size - 1]
        shingles = zip(*(part[i:] for i in range(size)), strict=False)
        yield np.array([xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles], dtype=np.uint64)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many rows of ``(n, lanes)`` hashes have each bit; 255 rows at a time can be added in one byte."""
    counts = np.zeros(64 * hashes.shape[1], dtype=np.int64)
    for start in range(0, len(hashes), 255):
        block = np.ascontiguousarray(hashes[start:start + 255], dtype="<u8").view(np.uint8)
        counts += np.add.reduce(np.unpackbits(block, axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return counts


def fingerprint(text: bytes, size: int) -> int:
    """Signed 64-bit SimHash of the shingles of a text in lower case; 0 if it has no words."""
    counts, total = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text.lower().split(), size):
        counts += _bit_counts(hashes[:, None])
        total += len(hashes)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(size: int):
    """An Arrow function from texts in UTF-8 to fingerprints."""

    @F.arrow_udf("bigint")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t, size) for t in text_values(texts)], pa.int64())

    return compute


def _rotated(start: Column) -> Column:
    """The fingerprint turned so that segment ``start`` holds its lowest bits."""
    turn = start * WIDTH
    up = F.when(start == 0, F.lit(0).cast("long")).otherwise(_shift_left(F.col("fp"), 64 - turn))
    return F.when(start == 0, F.col("fp")).otherwise(_shift_right(F.col("fp"), turn).bitwiseOR(up))


def _shift_left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits.cast("int"))


def _shift_right(value: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, bits.cast("int"))


def _masks(most: int, segment: int) -> Column:
    """Every way to flip up to ``most`` bits of a segment."""
    flips = (sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(WIDTH), n))
    values = (f << WIDTH * segment for f in flips)
    return F.array(*[F.lit(v - (1 << 64) if v >> 63 else v).cast("long") for v in values])


def _key(length: int) -> Column:
    return F.col("chain") if length == SEGMENTS else F.col("chain").bitwiseAND((1 << WIDTH * length) - 1)


def _lengthened(probe: DataFrame, length: int) -> DataFrame:
    """Each chain with every next segment that its budget of differing bits allows."""
    budget = length * RADIUS // SEGMENTS
    masks = _masks(budget, length - 1)
    if length > 2:
        masks = F.filter(masks, lambda m: F.bit_count(m) <= budget - F.col("used"))
    out = probe.withColumn("mask", F.explode(masks))
    return out.select(
        "fp", "start", F.col("chain").bitwiseXOR(F.col("mask")).alias("chain"),
        (F.col("used") + F.bit_count("mask")).alias("used"),
    )


def links(groups: DataFrame) -> DataFrame:
    """Stored pairs ``a < b`` of the distinct fingerprints ``fp`` that differ in at most three bits."""
    started = groups.select("fp", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("start"))
    index = started.select("fp", "start", _rotated(F.col("start")).alias("chain"))
    probe = index.withColumn("used", F.lit(0))
    found = []
    for length in range(2, SEGMENTS + 1):
        keyed = index.withColumn("key", _key(length))
        asked = _lengthened(probe, length).withColumn("key", _key(length))
        crowded = None
        if length < SEGMENTS:
            sizes = keyed.groupBy("start", "key").agg(F.count("*").alias("n"))
            crowded = stage(sizes.where(F.col("n") > CHAIN_LIMIT).select("start", "key"), "crowded-chains")
            n = crowded.count()
            crowded = spread(crowded, n) if n else None
        met = keyed.join(crowded, ["start", "key"], "left_anti") if crowded else keyed
        # Spark sizes an exploded table as it was before, so without the hint it may broadcast one many times that size.
        pairs = asked.hint("merge").join(met.select("start", "key", F.col("fp").alias("other")), ["start", "key"])
        near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS
        found.append(pairs.where((F.col("fp") < F.col("other")) & near).select(F.col("fp").alias("a"), F.col("other").alias("b")))
        if not crowded:
            break
        index = keyed.join(crowded, ["start", "key"], "left_semi").drop("key")
        probe = asked.join(crowded, ["start", "key"], "left_semi").drop("key")
    union = found[0]
    for other in found[1:]:
        union = union.unionByName(other)
    return stage(union.distinct(), "links")


def components(pairs: DataFrame) -> DataFrame:
    """Stored ``(fp, label)`` for the fingerprints of stored ``pairs``; ``label`` is the smallest one reachable.

    Each round takes the smallest label among the neighbours and then that label's own label, so the way to
    the smallest shrinks by more than half. Labels are written each round.
    """
    edges = stage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    n = edges.count()
    labels = stage(edges.groupBy(F.col("a").alias("fp")).agg(F.least(F.min("b"), F.col("fp")).alias("label")), "labels")
    while True:
        near = spread(edges, n).join(labels.select(F.col("fp").alias("b"), "label"), "b").groupBy(F.col("a").alias("fp")).agg(
            F.min("label").alias("near")
        )
        lower = spread(labels, n).join(near, "fp").select("fp", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        roots = labels.select(F.col("fp").alias("label"), F.col("label").alias("root"))
        jumped = spread(lower, n).join(roots, "label").select("fp", "was", F.least("label", "root").alias("label"))
        stored = stage(jumped, "labels")
        labels = stored.drop("was")
        if stored.where(F.col("label") != F.col("was")).isEmpty():
            return labels


def near_groups(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add ``component_id, keep_row`` to stored rows that have ``_row`` and a fingerprint ``fp``.

    ``component_id`` is the smallest id of the rows reachable by links, ``keep_row`` the row that has it (null
    ids last, then the first row). Answers go from each fingerprint to its groups of rows in one input partition,
    and from there to the rows, so a fingerprint that very many rows share is dealt to many tasks.
    """
    best = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("_row").alias("row")))
    n = rows.count()
    dealt = rows.withColumn("_run", F.shiftright("_row", 33))
    runs = dealt.groupBy("_run", "fp").agg(best.alias("first"))
    groups = stage(runs.groupBy("fp").agg(F.min("first").alias("first")), "fingerprints")
    found = components(links(groups))
    labelled = spread(groups, n).join(found, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    # Stored, so that the join below has a shuffle on both sides and a large component can be split.
    smallest = stage(labelled.groupBy("label").agg(F.min("first").alias("smallest")), "smallest")
    answers = spread(labelled.select("fp", "label"), n).join(smallest, "label").select("fp", "smallest")
    by_run = spread(runs.select("_run", "fp"), n).join(answers, "fp")
    return spread(dealt, n).join(by_run, ["_run", "fp"]).drop("_run").withColumns(
        {"component_id": F.col("smallest.id"), "keep_row": F.col("smallest.row")}
    ).drop("smallest")


def simhash_groups(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3) -> DataFrame:
    """``key, fingerprint, component_id`` for each row, the fingerprint as 16 hex digits.

    Null and empty texts have fingerprint 0 and are linked like any other. Texts of fewer words than a shingle
    are one shingle. Rows that repeat an id are linked like other rows. An empty table gives no rows.
    """
    rows = stage_rows(df.select(key, fingerprints(shingle)(F.col(text).cast("binary")).alias("fp")), "simhash-rows")
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return near_groups(rows, key).select(key, hexadecimal, "component_id")


def near_dedup(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3) -> DataFrame:
    """The rows of ``df`` that stay: of each component of ``simhash_groups``, the row of smallest id.

    Null ids come last; of rows that share an id the first stored one stays. Null and empty texts form one component
    with all others of fingerprint 0. An empty table gives no rows. All columns pass through, but for names that
    begin with an underscore.
    """
    rows = stage_rows(df, "near-rows")
    prints = stage(rows.select("_row", key, fingerprints(shingle)(F.col(text).cast("binary")).alias("fp")), "near-prints")
    kept = near_groups(prints, key).where(F.col("keep_row") == F.col("_row")).select("_row")
    return rows.join(kept, "_row", "left_semi").select(*df.columns)
