"""Language identification by the nearest of several centroids per language.

A text is a vector of its letter bigrams and trigrams (hashed, log counts times inverse document
frequency, unit length). Each language's training texts are clustered into a few centroids by spherical
k-means; a text takes the language of the centroid with the highest cosine, and is marked rejected when
that cosine is lower than nearly all training texts of the language had with theirs.

Training reads about ``per_language`` texts of each language, those whose hash of id and text is below a threshold
that follows from how many the language has, equal rows once; the number
of languages bounds the rest. Texts that are null or have no letter give ``und`` and score 0, as do all
texts when there is nothing to learn from. Ties go to the language that sorts first. Each row of the
input gives one row, also when ids repeat or are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

DIMENSIONS = 1 << 12
BLOCK = 256
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def counted(text: str | None) -> np.ndarray | None:
    """Counts of hashed letter bigrams and trigrams, other characters as one gap; null without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = letters()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, np.uint32(32))
    points = points[is_letter | np.concatenate([[True], is_letter[:-1]])]
    points = np.concatenate([[32], points, [32]]).astype(np.uint32)
    pairs = points[:-1] * np.uint32(0x9E3779B1) + points[1:] * np.uint32(0x85EBCA77)
    triples = pairs[:-1] * np.uint32(0xC2B2AE3D) + points[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
    grams = np.concatenate([pairs, triples])
    grams ^= grams >> np.uint32(15)
    grams *= np.uint32(0x2C1B3C6D)
    return np.bincount(grams >> np.uint32(20), minlength=DIMENSIONS)


def vectors(counts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(np.array(counts, dtype=np.float32).reshape(-1, DIMENSIONS)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def clustered(x: np.ndarray, clusters: int, rounds: int = 15) -> np.ndarray:
    """Unit centroids of spherical k-means, begun from texts far from each other."""
    centres = [x.mean(axis=0)]
    for _ in range(clusters - 1):
        centres.append(x[np.argmin((x @ np.array(centres).T).max(axis=1))])
    c = np.array(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        nearest = (x @ c.T).argmax(axis=1)
        c = np.array([x[nearest == i].sum(axis=0) if (nearest == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def fitted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, clusters: int):
    """(idf, centroids, language of each, least cosine of each language)."""
    known = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    texts = known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # a threshold of the hash for each language: no language's rows meet in a task, whatever share it has
    limits = texts.groupBy("lang").agg((F.least(F.lit(1.0), per_language / F.count("*")) * (1 << 31)).cast("long").alias("limit"))
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 31))
    chosen = texts.join(limits, "lang").where(place < F.col("limit")).select("id", "lang", "text").dropDuplicates()
    sample = staged(chosen, "language-sample")

    def document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, dtype=np.int64), 0
        for b in batches:
            for c in filter(lambda c: c is not None, map(counted, b.column(2).to_pylist())):
                seen += c > 0
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n], "seen": [seen.tolist()]})

    parts = sample.mapInArrow(document_frequency, "n long, seen array<long>").collect()
    total = sum(p.n for p in parts)
    if not total:
        return None
    df = np.sum([p.seen for p in parts], axis=0)
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(0.1)

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        counts = [c for c in map(counted, rows.sort_values("id")["text"]) if c is not None]
        if not counts:
            return pd.DataFrame({"lang": [], "centre": [], "least": []})
        x = vectors(counts, idf)
        c = clustered(x, min(clusters, len(x)))
        least = float(np.quantile((x @ c.T).max(axis=1), 0.01))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centre": [v.tolist() for v in c], "least": least})

    found = sample.groupBy("lang").applyInPandas(learn, "lang string, centre array<float>, least double").collect()
    found.sort(key=lambda r: r.lang)
    return idf, np.array([r.centre for r in found], dtype=np.float32), [r.lang for r in found], [r.least for r in found]


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    clusters: int = 4,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every whole text."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, id_col, text_col, lang_col, per_language, clusters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores, rejected = [], [], []
            texts = b.column(2).to_pylist()
            for at in range(0, len(texts), BLOCK):
                counts = [counted(t) for t in texts[at : at + BLOCK]]
                there = [c for c in counts if c is not None]
                if model.value is None or not there:
                    found = iter(())
                else:
                    idf, centres, names, least = model.value
                    cosines = vectors(there, idf) @ centres.T
                    best = cosines.argmax(axis=1)
                    found = zip([names[i] for i in best], cosines.max(axis=1).clip(0, 1).tolist(), [least[i] for i in best], strict=True)
                for c in counts:
                    lang, score, low = next(found) if c is not None and model.value is not None else ("und", 0.0, 0.0)
                    langs.append(lang)
                    scores.append(score)
                    rejected.append(lang == "und" or score < low)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
