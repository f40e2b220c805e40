"""Language identification by nearest centroid.

A text becomes a vector of hashed n-grams of its letters, weighted by TF-IDF and scaled to length one. Each
language has several centroids, found by clustering a bounded sample of its documents; the IDF counts cover all
documents that may be learned from. The nearest centroid by cosine names the language, and a text that is farther
from it than nearly all documents it was made of is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.common import BROADCAST_ROWS
from shelfsight.operators.ordering import cap_per_group
from shelfsight.staging import stage

UNKNOWN = "und"
BUCKETS = 4096
#: Labelled documents of each language that are clustered, and centroids made of them.
SAMPLE, CENTROIDS = 400, 3
#: Share of a centroid's own documents that are nearer to it than its limit.
WITHIN = 0.999
_ROUNDS, _CHUNK = 15, 256
_LETTER = re.compile(r"[^\W\d_]")
#: Everything in ASCII that is no letter separates words.
_ONLY_LETTERS = bytes(c if chr(c).isalpha() or c >= 0x80 else 0x20 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed byte n-grams, 2 to 4 long, of the words of a text."""
    body = b" " + b" ".join(text.lower().encode().translate(_ONLY_LETTERS).split()) + b" "
    counts = np.zeros(BUCKETS)
    for start in range(0, len(body), 1 << 20):
        code = np.frombuffer(body[start:start + (1 << 20) + 3], dtype=np.uint8).astype(np.uint64)
        gram = code
        for n in range(1, 4):
            gram = gram[:-1] * np.uint64(256) + code[n:]
            own = gram[: 1 << 20]
            bucket = ((own + np.uint64(n << 40)) * _MIX) >> np.uint64(52)
            counts += np.bincount(bucket.astype(np.int64), minlength=BUCKETS)
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


def vectorise(texts: list[str], idf: np.ndarray) -> np.ndarray:
    counts = np.stack([ngram_counts(t) for t in texts])
    return _unit(np.log1p(counts) * idf)


def cluster(vectors: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids by cosine k-means, begun far apart, and for each the cosine that ``WITHIN`` of its rows reach."""
    centres = [_unit(vectors.mean(axis=0))]
    while len(centres) < min(count, len(vectors)):
        centres.append(vectors[np.argmin((vectors @ np.stack(centres).T).max(axis=1))])
    matrix = np.stack(centres)
    for _ in range(_ROUNDS):
        owner = (vectors @ matrix.T).argmax(axis=1)
        matrix = np.stack([
            _unit(vectors[owner == i].mean(axis=0)) if (owner == i).any() else matrix[i] for i in range(len(matrix))
        ])
    near = vectors @ matrix.T
    owner = near.argmax(axis=1)
    limits = [np.quantile(near[owner == i, i], 1 - WITHIN) if (owner == i).any() else 1.0 for i in range(len(matrix))]
    return matrix, np.array(limits)


@dataclass
class LanguageModel:
    """``centroids`` and ``limits`` have a row for each entry of ``languages``."""

    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    limits: np.ndarray

    def predict(self, texts: list[str | None]) -> list[dict]:
        out: list[dict] = [{"lang_pred": UNKNOWN, "score": 0.0, "rejected": True} for _ in texts]
        if not self.languages:
            return out
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        for start in range(0, len(known), _CHUNK):
            part = known[start:start + _CHUNK]
            near = vectorise([texts[i] for i in part], self.idf) @ self.centroids.T
            for i, best, row in zip(part, near.argmax(axis=1), near, strict=True):
                score = float(np.clip(row[best], 0, 1))
                out[i] = {"lang_pred": self.languages[best], "score": score, "rejected": bool(score < self.limits[best])}
        return out


def _document_counts(df: DataFrame, text: str) -> np.ndarray:
    """In how many documents each bucket occurs, over all rows; each task hands over one sum for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, documents = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if has_letter(value):
                    seen += ngram_counts(value) > 0
                    documents += 1
        ids = np.append(np.arange(BUCKETS), -1)
        yield pa.RecordBatch.from_pydict({"bucket": ids, "n": np.append(seen, documents)})

    sums = df.select(text).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS + 1)
    for row in sums.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def fit(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        sample: int = SAMPLE, centroids: int = CENTROIDS) -> LanguageModel:
    """Learn from the rows of ``df`` that have a language and a letter.

    IDF counts cover all of them. Clustering takes the ``sample`` documents of each language whose ids have the
    smallest digests, and a task holds one language's sample. The model reaches the driver: ``BUCKETS`` counts
    and ``centroids`` vectors for each language.
    """
    usable = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = _document_counts(usable, text)
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1
    ids = usable.select(F.col(lang).alias("lang"), F.col(key).alias("id"))
    chosen = stage(cap_per_group(ids, "lang", sample, [F.xxhash64(F.col("id").cast("string")), F.col("id")]), "language-sample")
    few = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    named = usable.select(F.col(key).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    texts = named.join(few, ["id", "lang"], "left_semi")

    def of_language(rows: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in rows.sort_values("id")["text"] if has_letter(t)][:sample]
        if not texts:
            none = pd.DataFrame({"lang": [], "centroid": [], "limit": []}, dtype=object)
            return none.astype({"limit": float})
        matrix, limits = cluster(vectorise(texts, idf), centroids)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": list(matrix), "limit": limits})

    found = texts.groupBy("lang").applyInPandas(of_language, "lang string, centroid array<double>, limit double").collect()
    found.sort(key=lambda r: (r["lang"], r["limit"], r["centroid"]))
    return LanguageModel(
        idf, [r["lang"] for r in found], np.array([r["centroid"] for r in found]).reshape(-1, BUCKETS),
        np.array([r["limit"] for r in found]),
    )


def held_out(key: str) -> Column:
    """Rows that are never learned from: one in five by the digest of their id, and rows without an id."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(True))


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred, score, rejected``; only ``text`` is looked at.

    ``lang_pred`` is ``und`` with score 0 for a text that is null or has no letter, and for a model that has seen
    no language. ``score`` is the cosine to the nearest centroid. ``rejected`` texts lie outside of the limit of
    their centroid. Whole texts of any length count. An empty table gives no rows; input columns called like a
    result column are replaced, names that
    begin with an underscore are reserved.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("struct<lang_pred: string, score: double, rejected: boolean>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(sent.value.predict(texts.to_pylist()), kind)

    return df.withColumn("_language", predict(F.col(text))).withColumns(
        {c: F.col(f"_language.{c}") for c in ("lang_pred", "score", "rejected")}
    ).drop("_language")
