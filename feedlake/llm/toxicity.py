"""Toxicity scores: subword-bag embeddings averaged into a linear softmax.

A text is the average of the embeddings of the distinct character n-grams of its
words, with ``NEUTRAL`` n-grams of no meaning added so that a handful of words
proves little; a linear softmax on the average separates the classes. Embeddings and softmax are
trained jointly in numpy. An unseen or misspelt word shares n-grams, and so
vectors, with words seen in training. As average and softmax are linear, a
text's score only needs the softmax's value of each n-gram bucket: that table
of 2^16 numbers is what the tasks get.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, smallest_by_hash
from .ngrams import buckets, letters_only

SIZES = (3, 4, 5)
BITS = 16
DIMENSIONS = 8
#: Labelled documents that the model is fitted on, at most; those with the smallest hash of their id.
POSITIVES = 1_500
NEGATIVES = 3_000
NEUTRAL = 100
#: Passes over the sample, at least, and steps over batches, at least.
EPOCHS = 12
STEPS = 800
BATCH = 64
RATE = 0.2
#: A score from here on is predicted toxic.
THRESHOLD = 0.3


def _bag(text: str) -> np.ndarray:
    """The distinct n-gram buckets of a whole text's words."""
    found = buckets(letters_only(text), SIZES, BITS, within_words=True)
    return np.flatnonzero(np.bincount(found, minlength=1 << BITS))


@dataclass(frozen=True)
class ToxicityModel:
    """``values``: what an n-gram of each bucket adds to the log-odds; ``bias``: those of a text without any."""

    values: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        found = _bag(text or "")
        odds = self.bias + float(self.values[found].sum()) / (len(found) + NEUTRAL)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def _fit_arrays(starts: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Train on bags in CSR form; returns the value of each bucket and the bias."""
    rng = np.random.default_rng(7)
    size = 1 << BITS
    table = rng.uniform(-0.5, 0.5, (size, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    seen_table = np.full((DIMENSIONS, size), 1e-8, np.float32)
    seen_weights, seen_bias = np.full_like(weights, 1e-8), np.full_like(bias, 1e-8)
    weights += rng.normal(0, 0.1, weights.shape).astype(np.float32)
    wanted = np.eye(2, dtype=np.float32)[labels]
    # few positives weigh as if there were half as many of them as negatives
    positive = labels.mean()
    weight_of = np.where(labels == 1, max(1.0, 0.5 * (1 - positive) / positive), 1.0).astype(np.float32)
    epochs = max(EPOCHS, math.ceil(STEPS * BATCH / len(labels)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            lengths = starts[rows + 1] - starts[rows]
            ends = np.cumsum(lengths)
            owner = np.repeat(np.arange(len(rows)), lengths)
            pick = np.arange(ends[-1]) + np.repeat(starts[rows] - (ends - lengths), lengths)
            bucket = ids[pick].astype(np.int32)
            share = np.repeat((1 / (lengths + NEUTRAL)).astype(np.float32), lengths)[:, None]
            hidden = np.add.reduceat(table[bucket] * share, ends - lengths)
            logits = hidden @ weights + bias
            logits -= logits.max(1, keepdims=True)
            chance = np.exp(logits)
            chance /= chance.sum(1, keepdims=True)
            off = (chance - wanted[rows]) * (weight_of[rows] / len(rows))[:, None]
            slope = off @ weights.T
            pulls = slope[owner] * share
            for d in range(DIMENSIONS):
                pull = np.bincount(bucket, pulls[:, d], size).astype(np.float32)
                seen_table[d] += pull * pull
                table[:, d] -= rate * pull / np.sqrt(seen_table[d])
            push = hidden.T @ off
            seen_weights += push**2
            weights -= rate * push / np.sqrt(seen_weights)
            seen_bias += off.sum(0) ** 2
            bias -= rate * off.sum(0) / np.sqrt(seen_bias)
    return table @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> ToxicityModel:
    """Fit on a bounded sample of the labelled documents for which ``usable`` (on the id) holds.

    Of a document with several labels the largest counts; rows without id or
    label are left out, and so are labels without a document. Without documents
    of both classes the score of every text is the share of positive labels
    (0 if there are no labels). The model keeps the balance of the sample.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.where(usable) if usable is not None else known
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.when(F.col(label_col) > 0, 1).otherwise(0)).alias("y"))
    sizes = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = smallest_by_hash(known.where("y = 1"), "id", positives).unionByName(
        smallest_by_hash(known.where("y = 0"), "id", negatives)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    bags = texts.join(F.broadcast(picked), "id")  # at most positives + negatives rows

    def bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if len(found := _bag(text)):
                    # there are 2^16 buckets, so two bytes hold one
                    yield pa.RecordBatch.from_pydict({"y": [y], "ids": [found.astype(np.uint16).tobytes()]})

    found = bags.select("y", "text").mapInArrow(bagged, "y long, ids binary").toArrow()
    labels_of = found.column("y").to_numpy()
    if len(np.unique(labels_of)) < 2:
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        share = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(1 << BITS, np.float32), math.log(share / (1 - share)))
    sizes_of, content, first = (np.zeros(len(labels_of), np.int64) for _ in range(3))
    parts = [np.frombuffer(b.as_py(), np.uint16) for b in found.column("ids")]
    del found
    for k, part in enumerate(parts):
        sizes_of[k], content[k], first[k] = len(part), part.sum(dtype=np.int64), part[0]
    # a fixed order, so that a rerun fits the same model wherever the rows came from
    order = np.lexsort((first, content, sizes_of, labels_of))
    starts = np.concatenate(([0], np.cumsum(sizes_of[order])))
    ids = np.concatenate([parts[k] for k in order])
    labels_of = labels_of[order]
    del parts
    values, bias = _fit_arrays(starts, ids, labels_of)
    return ToxicityModel(values.astype(np.float32), bias)


def score_toxicity(df: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with a column ``out``: 0 to 1, higher where the label is likelier.

    Every whole text is scored; null and empty texts and those without a letter
    get the score of an empty bag. Repeated rows get the same score. A column
    named ``out`` is replaced, all others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.values, model.bias))

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = ToxicityModel(*shared.value)
        for texts in batches:
            yield pa.array([known.score(t.as_py()) for t in texts], pa.float64())

    made = free_name(df, "__toxicity")
    kept = [f"`{c}`" for c in df.columns if c.lower() != out.lower()]
    return df.withColumn(made, scores(F.col(text_col))).select(*kept, F.col(made).alias(out))
