"""Quality classification by importance resampling.

Two bags of hashed n-grams are counted: the target, labelled documents that are good, and the raw corpus, all of
it. A document counts each of its n-grams once, since words that one document repeats say little about others. Its
log weight is the sum over its n-grams of the logarithm of their ratio. Documents are then
resampled without replacement by the Gumbel top-k rule: a seeded Gumbel number is added to each log weight and
the ``k`` largest stay, ``k`` being the number of documents whose weight is that of a good one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.common import text_values
from shelfsight.operators.ordering import number_rows
from shelfsight.staging import stage

#: Buckets of each of two tables. An n-gram has a bucket in both, and the milder of their two ratios counts, so
#: sharing one bucket with a bad n-gram does no harm.
BUCKETS = 1 << 16
#: Labelled documents of either kind that are used, by the smallest digests of their ids.
LABELLED = 20_000
#: Occurrences that both models are taken to have seen of every n-gram, in the raw model's ratio.
PRIOR = 10.0
#: Log ratios nearer to 0 than this are taken for chance.
NOISE = 0.5
#: What log weights are multiplied by, unless the caller says otherwise, before the Gumbel numbers, of deviation 1.3, are
#: added: so much that a document clearly on one side stays there.
SHARPNESS = 20.0
_CACHE, _CACHED_LENGTH, _CHUNK = 500_000, 48, 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHAPE = bytes(
    0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x30 if 0x30 <= c <= 0x39 else c
    for c in range(256)
)
_IN_RUNS = np.isin(np.arange(256), list(b"Aa0"))
_THRICE = np.uint64(3)
_SHIFT = np.uint64(64 - (BUCKETS.bit_length() - 1))


class _Hashes(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= _CACHED_LENGTH:
            if len(self) >= _CACHE:
                self.clear()
            self[word] = value
        return value


def _shapes(text: bytes) -> set[bytes]:
    signs = np.frombuffer(text.translate(_SHAPE), dtype=np.uint8)
    again = np.zeros(len(signs), dtype=bool)
    again[1:] = (signs[1:] == signs[:-1]) & _IN_RUNS[signs[1:]]
    return set(signs[~again].tobytes().split())


def ngram_buckets(text: bytes, hashes: dict) -> np.ndarray:
    """``(2, n)`` buckets of the distinct n-grams of a text, one row for each table.

    They are its words, its pairs of neighbouring words, the shapes of its words (runs of letters of one case and of
    digits being one sign each), and one for a word that comes three times in a row.
    """
    words = text.lower().split()
    shapes = _shapes(text)
    found = np.array([xxhash.xxh64_intdigest(s, 1) for s in shapes], dtype=np.uint64)
    for start in range(0, len(words), _CHUNK):
        part = words[start:start + _CHUNK + 2]
        ids = np.fromiter(map(hashes.__getitem__, part), dtype=np.uint64, count=len(part))
        pairs = (ids[:-1] * _MIX ^ (ids[1:] >> np.uint64(7))) * _MIX
        if ((ids[:-2] == ids[1:-1]) & (ids[1:-1] == ids[2:])).any():
            found = np.append(found, _THRICE)
        found = np.sort(np.concatenate([found, ids[:_CHUNK], pairs]))
        found = found[np.append(True, found[1:] != found[:-1])]
    first = (found >> _SHIFT).astype(np.int64)
    second = ((found ^ (found >> np.uint64(29))) * _MIX >> _SHIFT).astype(np.int64)
    return np.stack([first, second + BUCKETS])


class _Tally:
    """Counts of buckets, added up a million at a time."""

    def __init__(self) -> None:
        self.counts, self._waiting, self._size = np.zeros(2 * BUCKETS, dtype=np.int64), [], 0

    def add(self, buckets: np.ndarray) -> None:
        self._waiting.append(buckets)
        self._size += len(buckets)
        if self._size > 1_000_000:
            self.total()

    def total(self) -> np.ndarray:
        if self._waiting:
            self.counts += np.bincount(np.concatenate(self._waiting), minlength=2 * BUCKETS)
            self._waiting, self._size = [], 0
        return self.counts


def _counts(df: DataFrame, text: str, target: Column) -> np.ndarray:
    """``(2, 2 * BUCKETS)`` rows that have an n-gram, of all and of the target rows. Each task hands over what it has counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good, hashes = _Tally(), _Tally(), _Hashes()
        for batch in batches:
            flags = batch.column(1).to_pylist()
            for value, is_target in zip(text_values(batch.column(0)), flags, strict=True):
                buckets = ngram_buckets(value, hashes).ravel()
                raw.add(buckets)
                if is_target:
                    good.add(buckets)
        seen = np.flatnonzero(raw.total())
        yield pa.RecordBatch.from_pydict({"bucket": seen, "raw": raw.total()[seen], "good": good.total()[seen]})

    texts = df.select(F.col(text).cast("binary"), target.alias("target"))
    sums = texts.mapInArrow(count, "bucket bigint, raw bigint, good bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("good").alias("good")
    )
    counts = np.zeros((2, 2 * BUCKETS))
    for bucket, raw, good in sums.collect():
        counts[:, bucket] = raw, good
    return counts


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log of target over raw for each bucket, 0 where it is within ``NOISE``.

    The scale between both is the weighted median of their ratios, so a usual n-gram has 0 and the length of a
    document alone neither helps nor harms it.
    """
    raw, good = counts
    used = np.flatnonzero((raw > 0) & (good > 0))
    if not len(used):
        return np.zeros(2 * BUCKETS)
    ratio = good[used] / raw[used]
    order = np.argsort(ratio)
    weight = np.cumsum(raw[used][order])
    scale = ratio[order][np.searchsorted(weight, weight[-1] / 2)]
    logs = np.log((good + PRIOR) / (scale * raw + PRIOR))
    return np.where(np.abs(logs) < NOISE, 0.0, logs)


def log_weight(ratios: np.ndarray, buckets: np.ndarray) -> float:
    one, two = ratios[buckets]
    return float(np.where(one * two > 0, np.where(np.abs(one) < np.abs(two), one, two), 0.0).sum())


def _labelled(labels: DataFrame, key: str, good: Column, limit: int) -> DataFrame:
    """``_id, _good`` of about ``limit`` labelled rows of either kind, those with the smallest digests."""
    ids = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.min(F.coalesce(good, F.lit(False))).alias("_good"))
    totals = {r[0]: r[1] for r in ids.groupBy("_good").count().collect()}
    share = F.when(F.col("_good"), limit / max(1, totals.get(True, 0))).otherwise(limit / max(1, totals.get(False, 0)))
    place = F.pmod(F.xxhash64(F.lit("labelled"), "_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return stage(ids.where(place < share), "labelled")


def weigher(df: DataFrame, ratios: np.ndarray, text: str = "text") -> Column:
    """``n_grams`` and ``log_weight`` of each text; a null or empty text has none and weight 0."""
    sent = df.sparkSession.sparkContext.broadcast(ratios)
    kind = pa.struct([("n_grams", pa.int64()), ("log_weight", pa.float64())])

    @F.arrow_udf("struct<n_grams: bigint, log_weight: double>")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, hashes = sent.value, _Hashes()
        for texts in batches:
            rows = []
            for value in text_values(texts):
                buckets = ngram_buckets(value, hashes)
                rows.append({"n_grams": buckets.shape[1], "log_weight": log_weight(table, buckets)})
            yield pa.array(rows, kind)

    return weigh(F.col(text).cast("binary"))


def _score(weight: str, key: str, seed: int, sharpness: float) -> Column:
    """The log weight, sharpened, with the Gumbel number of the row's id."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key).cast("string")), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.col(weight) * sharpness - F.log(-F.log(uniform))


def least_good_weight(weights: DataFrame) -> float:
    """The weight that parts labelled good rows from others best; ``weights`` has ``log_weight, _good``.

    The labelled rows are few, by a parameter, so their weights come to the driver as they are. The result lies halfway
    between two of them, and is minus infinity if no weight parts them.
    """
    rows = sorted((r["log_weight"], r["_good"]) for r in weights.select("log_weight", "_good").collect())
    totals = {g: max(1, sum(good == g for _, good in rows)) for g in (True, False)}
    best, cut, kept = 0.0, float("-inf"), {True: 1.0, False: 1.0}
    for (weight, good), (following, _) in zip(rows, rows[1:], strict=False):
        kept[good] -= 1 / totals[good]
        if following > weight and kept[True] - kept[False] > best + 1e-12:
            best, cut = kept[True] - kept[False], (weight + following) / 2
    return cut


def fit_and_choose(df: DataFrame, labels: DataFrame, good: Column, text: str, key: str, labelled: int, seed: int,
                   sharpness: float, carried: tuple[str, ...] = ()) -> tuple[float, DataFrame]:
    """The score of the last document of the top ``k``, and the stored weights of all rows."""
    marked = _labelled(labels, key, good, labelled)
    with_label = df.join(F.broadcast(marked), F.col(key) == F.col("_id"), "left")
    ratios = log_ratios(_counts(with_label, text, F.coalesce(F.col("_good"), F.lit(False))))
    weighed = with_label.select(*carried, key, "_good", weigher(df, ratios, text).alias("_found"))
    stored = stage(weighed.select(*carried, key, "_good", "_found.*"), "log-weights")
    cut = least_good_weight(stored.where(F.col("_good").isNotNull()))
    k = stored.where(F.col("log_weight") >= cut).count()
    scored = stored.withColumn("score", _score("log_weight", key, seed, sharpness))
    ranked = number_rows(scored.select(F.col("score").alias("_score")), [F.col("_score").desc()], "_rank")
    last = ranked.where(F.col("_rank") == k - 1).first() if k else None
    return last[0] if last else float("inf"), scored


def quality_scores(df: DataFrame, labels: DataFrame, good: Column, text: str = "text", key: str = "doc_id",
                   labelled: int = LABELLED, seed: int = 5, sharpness: float = SHARPNESS) -> DataFrame:
    """``key, n_grams, log_weight, score, kept`` for every row.

    ``good`` is the condition on ``labels`` for a target document. ``k`` is the number of rows whose log weight is
    at least the one that best parts labelled good rows from labelled others; the ``k`` rows with the largest
    scores are kept, and further rows that tie with the last. Log weights are multiplied by ``sharpness`` before the
    Gumbel numbers are added: 1 draws in proportion to the weights, more keeps the heavier ones. Without labels of both
    kinds all rows are kept. Null and empty texts weigh 0, like a usual text. Rows that repeat an id share their Gumbel
    number, an id with several labels is good only if all are. An empty table gives no rows. Other columns are not read.
    """
    last, scored = fit_and_choose(df.select(key, text), labels, good, text, key, labelled, seed, sharpness)
    return scored.select(key, "n_grams", "log_weight", "score", (F.col("score") >= last).alias("kept"))


def resample(df: DataFrame, labels: DataFrame, good: Column, text: str = "text", key: str = "doc_id",
             labelled: int = LABELLED, seed: int = 5, sharpness: float = SHARPNESS) -> DataFrame:
    """The rows of ``df`` that are kept, with their columns, whatever their names; see :func:`quality_scores`.

    The rows are stored once, with their weights, so no text is weighed twice and none is shuffled.
    """
    whole = df.select(F.col(key).alias(key), F.col(text).alias(text), F.struct("*").alias("_whole"))
    last, scored = fit_and_choose(whole, labels, good, text, key, labelled, seed, sharpness, ("_whole",))
    return scored.where(F.col("score") >= last).select("_whole.*")
