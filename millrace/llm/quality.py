"""Quality classifier: ordinal cumulative-link regression on hashed text.

A rating has a grade from 0 up. One weight vector scores a text and ordered thresholds
cut the score: ``P(grade >= k) = 1 / (1 + exp(threshold_k - score))``. The expected
grade is the sum of these tail probabilities, and the tail of the best grade selects.

Features: which words occur (hashed), and bucketed shape figures, hashed into the same
vector: how many words there are, what share of them is distinct or repeats the word
before, their mean length and the share of bytes that are no letters. Whole texts count.

The model is fitted on at most ``SAMPLE`` rated documents, those with the smallest hash
of their doc_id: only their features reach the driver. Scoring covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rated documents that the fit uses at most.
SAMPLE = 10_000
DIMENSIONS = 1 << 18
#: Features that fewer sampled documents have get no weight.
LEAST_DOCUMENTS = 4
ROUNDS = 400
PENALTY = 0.0004
RATE = 0.3
#: Words whose weights one task remembers.
REMEMBERED = 500_000

_MARKS = b".,;:!?\"'()|"
_AS_SPACES = bytes(32 if b in _MARKS else b for b in range(256))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)) + b" \t\n\v\f\r"


def slot(feature: bytes) -> int:
    return xxhash.xxh3_64_intdigest(feature) % DIMENSIONS


def shape(raw: bytes, words: list[bytes], distinct: int) -> list[bytes]:
    """Names of the buckets a text falls into."""
    n = len(words)
    if not n:
        return [b"\0empty"]
    size = sum(map(len, words))
    again = sum(map(eq, words, words[1:]))
    others = len(raw.translate(None, _LETTERS))
    length = n.bit_length()
    return [
        b"\0words %d" % length,
        b"\0distinct %d of %d" % (10 * distinct // n, min(length, 8)),
        b"\0again %d" % min(10, 50 * again // n),
        b"\0length %d" % min(20, size // n),
        b"\0others %d" % min(15, 50 * others // size),
    ]


def features(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().translate(_AS_SPACES).split()
    distinct = set(words)
    return [*distinct, *shape(raw, words, len(distinct))]


def grade(quality: Column, toxic: Column) -> Column:
    """0: toxic, 1: poor, 2: good; null where neither rating is given."""
    return (
        F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2).cast("int")
    )


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """``P(grade >= k)`` for k = 1, 2, ..., one column each."""
        z = np.clip(score[:, None] - self.thresholds[None, :], -500, 500)
        return 1 / (1 + np.exp(-z))


def fit(slots: list[np.ndarray], grades: np.ndarray) -> Model:
    """Likelihood with an absolute-value penalty, by adaptive proximal gradient steps.

    Thresholds are a first value and positive gaps, so they stay in order. With fewer
    than two grades in the sample, or none at all, weights are zero and the thresholds
    put every text at the highest grade seen.
    """
    weights = np.zeros(DIMENSIONS)
    top = int(grades.max()) if len(grades) else 0
    kinds = max(1, top)
    if len(set(grades.tolist())) < 2:
        return Model(weights, np.where(np.arange(kinds) < top, -20.0, 20.0) if top else np.array([20.0]))
    sizes = np.array([len(s) for s in slots])
    flat = np.concatenate(slots)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    known, index = np.unique(flat, return_inverse=True)
    used = np.bincount(index) >= LEAST_DOCUMENTS
    w = np.zeros(len(known))
    # Tail probabilities at the start are those of the sample.
    tail = np.array([np.mean(grades >= k + 1) for k in range(kinds)])
    cut = -np.log(np.clip(tail, 1e-3, 1 - 1e-3) / (1 - np.clip(tail, 1e-3, 1 - 1e-3)))
    first, gaps = cut[0], np.log(np.maximum(np.diff(cut), 1e-2))
    squares, squares_cut = np.full(len(known), 1e-8), np.full(kinds, 1e-8)
    rows = np.arange(len(grades))
    for _ in range(ROUNDS):
        thresholds = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        score = np.add.reduceat(w[index], starts)
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -500, 500)))
        upper = np.column_stack([np.ones(len(rows)), p, np.zeros(len(rows))])
        slope = upper * (1 - upper)
        chance = np.maximum(upper[rows, grades] - upper[rows, grades + 1], 1e-12)
        by_score = -(slope[rows, grades] - slope[rows, grades + 1]) / chance / len(rows)
        by_cut = np.zeros((len(rows), kinds + 2))
        by_cut[rows, grades] += slope[rows, grades] / chance
        by_cut[rows, grades + 1] -= slope[rows, grades + 1] / chance
        by_cut = by_cut[:, 1:-1].mean(axis=0)
        g = np.bincount(index, np.repeat(by_score, sizes), len(known)) * used
        squares += g * g
        step = RATE / np.sqrt(squares)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * PENALTY, 0)
        g_first = by_cut.sum()
        g_gaps = np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(gaps)
        both = np.concatenate(([g_first], g_gaps))
        squares_cut += both * both
        step = RATE * both / np.sqrt(squares_cut)
        first, gaps = first - step[0], gaps - step[1:]
    weights[known] = w
    return Model(weights, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))))


def train(docs: DataFrame, ratings: DataFrame) -> Model:
    """The model of ``ratings`` (``doc_id, grade``) over the texts of ``docs``.

    Ratings with a null doc_id or grade, or without a document, are not used.
    """
    sample = (
        ratings.filter("doc_id IS NOT NULL AND grade IS NOT NULL")
        .select(F.col("doc_id").alias("_rated"), "grade")
        .orderBy(F.xxhash64("_rated"), "_rated", "grade")
        .limit(SAMPLE)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({slot(f) for f in features(t.as_py())}) for t in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))],
                ["doc_id", "grade", "slots"],
            )

    # The sample has at most SAMPLE rows of two numbers.
    rated = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), F.col("doc_id") == F.col("_rated"))
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"), "grade")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", "grade")
    )
    rows = rated.mapInArrow(run, "doc_id bigint, grade int, slots array<int>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("grade", "ascending")])
    slots = [np.asarray(s, np.int64) for s in rows.column("slots").to_pylist()]
    return fit(slots, rows.column("grade").to_numpy())


class _Weights(dict):
    """Weights of words, looked up once each."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, feature: bytes) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[feature] = float(self.weights[slot(feature)])
        return found


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``top_probability`` added.

    A null text counts as an empty one. Other columns may be null and are passed on;
    columns of those two names are replaced. Repeated rows are scored alike.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        (model.weights.astype(np.float32), model.thresholds)
    )  # DIMENSIONS numbers, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, thresholds = shared.value
        known, judge = _Weights(weights), Model(weights, thresholds)
        weight = known.__getitem__
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            scores = np.array(
                [sum(map(weight, features(t.as_py()))) for t in text], np.float64
            )
            tails = judge.tails(scores)
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            columns["expected_grade"] = pa.array(tails.sum(axis=1))
            columns["top_probability"] = pa.array(tails[:, -1])
            yield pa.record_batch(list(columns.values()), list(columns))

    plain = docs.drop("expected_grade", "top_probability")
    schema = plain.withColumns(
        {"expected_grade": F.lit(0.0), "top_probability": F.lit(0.0)}
    ).schema
    return plain.mapInArrow(run, schema)


def select_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` whose probability of the best grade is ``least`` or more."""
    return scored(docs, model).filter(F.col("top_probability") >= least).select(*docs.columns)
