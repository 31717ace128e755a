"""Toxicity from confirmed examples and unlabelled text: non-negative positive-unlabelled learning.

No text is taken as known to be clean. The risk of a classifier g is
``p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)])``: what unlabelled text costs as
clean, less the part that its toxic share p causes. Where that difference falls
below zero, the classifier has begun to fit single texts, and its gradient is
reversed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.llm.common import held_out, text_batches
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

TOKEN = re.compile(r"\w+")


@dataclass(frozen=True)
class Fit:
    """Bounds of the training sample and of the optimisation."""

    positives: int = 4000  # confirmed examples, at most
    unlabelled: int = 12000  # unlabelled texts, at most
    vocabulary: int = 6000  # words, at most: those of most positives
    least_share: float = 0.03  # of the positives that must hold a word of the vocabulary
    contrast: float = 6.0  # standard errors by which its share must exceed that of unlabelled texts
    steps: int = 250
    rate: float = 0.1
    decay: float = 1e-4
    classifiers: int = 3  # each on its own part of the unlabelled texts
    seed: int = 5


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -20.0

    def score(self, text: str | None) -> float:
        get = self.weights.get
        g = self.bias + sum(get(w, 0.0) for w in words_of(text))
        return float(1 / (1 + np.exp(-np.clip(g, -60, 60))))


def words_of(text: str | None) -> set[str]:
    return set(TOKEN.findall(text.lower())) if text else set()


class Presence:
    """Which words of the vocabulary each text holds, as one flat array."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.n, self.width = len(rows), width
        self.flat = np.concatenate([np.empty(0, np.int32), *rows])
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def scores(self, w: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.row, w[self.flat], self.n)

    def gradient(self, slope: np.ndarray) -> np.ndarray:
        by_word = np.bincount(self.flat, slope[self.row], self.width)
        return np.append(by_word, slope.sum())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def descend(positive: Presence, unlabelled: Presence, prior: float, fit: Fit) -> tuple[np.ndarray, float]:
    """Weights and bias of least non-negative risk under the logistic loss, by Adam."""
    w = np.zeros(positive.width + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, fit.steps + 1):
        gp, gu = positive.scores(w[:-1], w[-1]), unlabelled.scores(w[:-1], w[-1])
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        as_negative = unlabelled.gradient(_sigmoid(gu) / unlabelled.n) - positive.gradient(
            prior * _sigmoid(gp) / positive.n
        )
        as_positive = positive.gradient(-prior * _sigmoid(-gp) / positive.n)
        slope = as_positive + as_negative if negative >= 0 else -as_negative
        slope[:-1] += fit.decay * w[:-1]
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w -= fit.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _index(texts: DataFrame, vocabulary: list[str]) -> list[np.ndarray]:
    """The vocabulary words of each text, worked out on the executors."""
    at = {w: i for i, w in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            rows = [sorted(at[w] for w in words_of(t.as_py()) if w in at) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("t"), pa.array(rows, pa.list_(pa.int32()))], names=["k", "t", "at"]
            )

    keyed = texts.select("k", F.xxhash64("text").alias("t"), "text")
    found = keyed.mapInArrow(run, "k long, t long, at array<int>").toArrow()
    found = found.sort_by([("k", "ascending"), ("t", "ascending")])
    return [np.asarray(x, np.int32) for x in found.column("at").to_pylist()]


def _holders(texts: DataFrame) -> DataFrame:
    """How many texts hold each word; the words are those that scores read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            held = Counter(w for t in batch.column("text") for w in words_of(t.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )

    held = texts.select("text").mapInArrow(run, "word string, n long")
    return held.groupBy("word").agg(F.sum("n").alias("count"))


def telling(vocabulary, positive, unlabelled, fit: Fit):
    """Only words more common among the confirmed than among unlabelled texts, beyond chance."""
    width = len(vocabulary)
    among = np.bincount(np.concatenate(positive), minlength=width) / len(positive)
    usual = (np.bincount(np.concatenate(unlabelled), minlength=width) + 1) / (len(unlabelled) + 2)
    stays = among - usual > fit.contrast * np.sqrt(usual * (1 - usual) / len(positive))
    new = np.cumsum(stays) - 1
    kept = [[new[r[stays[r]]].astype(np.int32) for r in rows] for rows in (positive, unlabelled)]
    return [w for w, ok in zip(vocabulary, stays) if ok], *kept


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """Fit on learning rows only: those whose crc32(doc_id) mod 5 is not 0.

    The sample is bounded (``fit``) and chosen by a hash of doc_id, the same for every
    layout of the rows; of several texts of one confirmed id the least is taken. The toxic
    share is that of all labelled learning documents; one labelled more than once counts
    once, as toxic if any of its labels says so. Without
    any confirmed example the model calls nothing toxic.
    """
    learn = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    learn = learn.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known, toxic = learn.agg(F.count("*"), F.sum(F.col("toxic").cast("long"))).first()
    if not toxic:
        return Model()
    prior = min(max(toxic / known, 1e-3), 0.9)
    order = F.xxhash64("doc_id")

    def part(rows: DataFrame, n: int, most: int, *ties) -> DataFrame:
        share = min(1.0, most / max(n, 1))
        near = rows.where(F.pmod(order, F.lit(1_000_000)) < int(1_000_000 * share))
        return near.orderBy(order, *ties).limit(most)

    ids = part(learn.where("toxic = 1").select("doc_id"), toxic, fit.positives)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    confirmed = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    confirmed = confirmed.select(order.alias("k"), "text")
    n = docs.count()
    others = part(texts.where(~held_out(F.col("doc_id"))), n, fit.unlabelled, F.xxhash64("text"))
    others = others.select(order.alias("k"), "text")

    n_confirmed = min(toxic, fit.positives)
    counted = _holders(confirmed)
    least = max(3, int(fit.least_share * n_confirmed))
    vocabulary = [
        r["word"]
        for r in counted.where(F.col("count") >= least)
        .orderBy(F.desc("count"), "word")
        .limit(fit.vocabulary)
        .collect()
    ]
    positive, unlabelled = _index(confirmed, vocabulary), _index(others, vocabulary)
    if not positive or not unlabelled:
        return Model()
    vocabulary, positive, unlabelled = telling(vocabulary, positive, unlabelled, fit)
    dealt = np.random.default_rng(fit.seed).permutation(len(unlabelled))
    parts = [p for p in np.array_split(dealt, fit.classifiers) if len(p)]
    fitted = [
        descend(Presence(positive, len(vocabulary)), Presence([unlabelled[i] for i in p], len(vocabulary)), prior, fit)
        for p in parts
    ]
    mean = np.mean([w for w, _ in fitted], axis=0)
    return Model(
        {w: float(x) for w, x in zip(vocabulary, mean) if abs(x) > 1e-6},
        float(np.mean([b for _, b in fitted])),
    )


def score(docs: DataFrame, model: Model, to: str = "toxicity") -> DataFrame:
    """``docs`` with the column ``to``: how likely the whole text is toxic, from 0 to 1.

    Null and empty texts score by the bias alone, long ones by all their words. A column
    named like ``to`` is replaced; all others and all rows stay, repeated ones with equal
    scores. An empty table gives an empty one.
    """
    docs = docs.drop(to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            scores = [model.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, to]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(to, T.DoubleType())]))


def keep(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below ``threshold``, with their own columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            clean = pa.array([model.score(t.as_py()) < threshold for t in batch.column("text")], pa.bool_())
            yield batch.filter(clean)

    return docs.mapInArrow(run, docs.schema)
