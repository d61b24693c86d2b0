"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are words, and beginnings of 4 to 8 letters that one, two or four different words share. P(grade
>= k) is the logistic of a score minus the k-th of ordered thresholds; the score, a weighted sum of the
features present, has the same weights for every threshold. Severity is the expected grade.

The labels say only whether a text is toxic, so grades are made from them: clean texts are 0, toxic ones
1 to 3 by thirds of how many of the features that toxic texts favour they hold. Features enter when their
log-likelihood ratio between the two labels is above ``least_ratio``. About ``sample_rows`` labelled
texts are read, chosen by a hash of the id: about half of the bound of either label at most.

Null and empty texts have no features, and so the score zero, under all thresholds. Labels that are null or
contradict each other are left out; without both labels nothing is toxic. Each row of the input gives one
row, also when ids repeat or are null.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = range(4, 9)
TIMES = (1, 2, 4)


def begun(words: set[str], sizes) -> Counter:
    """How many of the words begin with each beginning that is shorter than the word."""
    return Counter(w[:size] for w in words for size in sizes if size < len(w))


def marked(begin: str, n: int) -> list[str]:
    """The features of a beginning that n different words have: once, twice, four times."""
    return [f"{begin}*{t}" for t in TIMES if n >= t]


def features_of(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    return words.union(*(marked(b, n) for b, n in begun(words, PREFIXES).items()))


class OrdinalModel:
    """Weights by feature, thresholds in ascending order; texts with P(grade >= 1) over ``cut`` count as toxic."""

    def __init__(self, weights: dict[str, float], thresholds: list[float], cut: float = 0.5):
        self.weights, self.thresholds, self.cut = weights, thresholds, cut
        self.begins = {f.rpartition("*")[0] for f in weights if "*" in f}
        self.sizes = sorted({len(b) for b in self.begins})

    def at_least(self, text: str | None) -> list[float]:
        """P(grade >= k) for k from 1."""
        words = set(WORD.findall((text or "").lower()))
        found = words & self.weights.keys()
        counts = Counter(b for w in words for size in self.sizes if size < len(w) and (b := w[:size]) in self.begins)
        found.update(f for b, n in counts.items() for f in marked(b, n) if f in self.weights)
        score = sum(self.weights[f] for f in sorted(found))
        return [1 / (1 + math.exp(min(max(t - score, -500), 500))) for t in self.thresholds]


def fit(rows: list[list[int]], grades: np.ndarray, width: int, decay: float = 0.02, rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised loss, by Adam; rows list the features present.

    Thresholds are the first and its ordered successors' logarithmic distances. A grade's probability
    is the difference of two logistics.
    """
    row = np.array([i for i, r in enumerate(rows) for _ in r], dtype=np.int64)
    column = np.array([c for r in rows for c in r], dtype=np.int64)
    n, top = len(rows), int(grades.max())
    params = np.concatenate([np.zeros(width), [1.0], np.zeros(top - 1)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        w, steps = params[:width], np.concatenate([params[width : width + 1], np.exp(params[width + 1 :])])
        theta = np.concatenate([[-np.inf], np.cumsum(steps), [np.inf]])
        score = np.bincount(row, weights=w[column], minlength=n)
        above = 1 / (1 + np.exp(np.clip(score - theta[grades + 1], -500, 500)))  # P(grade <= g)
        below = 1 / (1 + np.exp(np.clip(score - theta[grades], -500, 500)))  # P(grade <= g - 1)
        chance = np.maximum(above - below, 1e-12)
        d_above, d_below = above * (1 - above), below * (1 - below)
        d_score = (d_above - d_below) / chance / n
        grad = np.zeros_like(params)
        grad[:width] = np.bincount(column, weights=d_score[row], minlength=width) + decay / n * w
        d_theta = np.bincount(grades, weights=-d_above / chance / n, minlength=top + 1)[:top]
        d_theta += np.bincount(grades, weights=d_below / chance / n, minlength=top + 1)[1:]
        tail = np.cumsum(d_theta[::-1])[::-1]
        grad[width:] = tail * np.concatenate([[1.0], steps[1:]])
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        params = params - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return params[:width], np.cumsum(np.concatenate([params[width : width + 1], np.exp(params[width + 1 :])]))


def best_cut(chances: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the best F1 over the sample, in the middle of the gap below the last chance that it keeps."""
    levels = np.unique(chances)
    hits = np.array([(toxic & (chances >= c)).sum() for c in levels])
    f1 = 2 * hits / (toxic.sum() + np.array([(chances >= c).sum() for c in levels]))
    at = int(f1.argmax())
    return float((levels[at] + levels[at - 1]) / 2) if at else 0.5


def ratio(a, b, n_a: float, n_b: float):
    """The log-likelihood ratio of a word in a of n_a and b of n_b texts."""
    p = (a + b) / (n_a + n_b)

    def part(k, n):
        q = F.greatest(k / n, F.lit(1e-12))
        r = F.greatest(1 - k / n, F.lit(1e-12))
        return k * F.log(q / p) + (n - k) * F.log(r / F.greatest(1 - p, F.lit(1e-12)))

    return 2 * (part(a, n_a) + part(b, n_b))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = 8000,
    features: int = 2000,
    least_ratio: float = 25.0,
) -> OrdinalModel:
    clear = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    clear = clear.where("toxic = most and id is not null").select("id", "toxic")
    sizes = {r.toxic: r["count"] for r in clear.groupBy("toxic").count().collect()}
    # about half of the bound from either label; which, a hash says
    share = F.when(F.col("toxic") == 1, F.lit(sizes.get(1, 1))).otherwise(F.lit(sizes.get(0, 1)))
    chosen = clear.where(F.pmod(F.xxhash64("id"), share) < sample_rows // 2)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id")  # at most sample_rows ids and labels

    def bags_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(features_of(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int32()), pa.array(found, pa.list_(pa.string()))], ["toxic", "features"])

    bags = staged(sample.select("toxic", "text").mapInArrow(bags_of, "toxic int, features array<string>"), "toxicity-sample")
    sizes = {r.toxic: r["count"] for r in bags.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return OrdinalModel({}, [50.0, 51.0, 52.0])
    counts = bags.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")
    )
    g = ratio(F.col("a"), F.col("b"), float(sizes[1]), float(sizes[0]))
    picked = counts.where(F.col("a") + F.col("b") >= 3).withColumn("g", g).where(F.col("g") >= least_ratio)
    picked = picked.orderBy(F.desc("g"), "feature").limit(features).collect()
    number = {r.feature: i for i, r in enumerate(picked)}
    favoured = {i for i, r in enumerate(picked) if r.a / sizes[1] > r.b / sizes[0]}
    names = F.array(*[F.lit(f) for f in number]) if number else F.array().cast("array<string>")
    slim = bags.select("toxic", F.array_intersect("features", names).alias("features"))
    known = sorted((r.toxic, sorted(number[f] for f in r.features)) for r in slim.collect())  # at most sample_rows short rows
    hits = [len(favoured.intersection(r)) for _, r in known]
    cuts = np.quantile([h for h, (t, _) in zip(hits, known, strict=True) if t], [1 / 3, 2 / 3])
    grades = np.array([1 + int(np.searchsorted(cuts, h)) if t else 0 for h, (t, _) in zip(hits, known, strict=True)])
    grades = np.searchsorted(np.unique(grades), grades)
    weights, thresholds = fit([r for _, r in known], grades, len(number))
    scores = np.array([sum(weights[i] for i in r) for _, r in known])
    cut = best_cut(1 / (1 + np.exp(np.clip(thresholds[0] - scores, -500, 500))), np.array([t for t, _ in known], dtype=bool))
    return OrdinalModel(dict(zip(number, weights.tolist(), strict=True)), thresholds.tolist(), cut)


def severity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, p_toxic, toxic): the expected grade, P(grade >= 1), and whether that is over the model's cut."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chances = [shared.value.at_least(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sum(c) for c in chances], pa.float64()), pa.array([c[0] for c in chances], pa.float64()), pa.array([c[0] > shared.value.cut for c in chances], pa.bool_())],
                ["doc_id", "severity", "p_toxic", "toxic"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, severity double, p_toxic double, toxic boolean")


def without_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The rows whose text is not toxic, with their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([shared.value.at_least(t)[0] <= shared.value.cut for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
