"""Language identification by error-correcting output codes.

Each language has a codeword of bits. For each bit one binary classifier over
hashed character n-grams is trained; a text's bits are decoded by the loss of
every codeword, each bit weighted by how well its classifier does for that
language, and the nearest codeword wins. A text is flagged as ambiguous if the
runner-up is about as near, or if more bits are off than the code can correct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name
from .ngrams import buckets, letters_only

SIZES = (1, 2, 3)
BITS = 12
#: Labelled documents of a language that the classifiers are fitted on, about.
PER_LANGUAGE = 400
#: Bits of a codeword, at most; fewer languages have the full exhaustive code.
CODE_BITS = 31
STEPS = 150
RATE = 0.05
#: A winner's score under this is ambiguous.
CLEAR = 0.6
UNKNOWN = "und"


def codewords(count: int, bits: int = CODE_BITS) -> np.ndarray:
    """A (count x bits) matrix of -1 and 1 whose rows lie far apart.

    All ways to split the languages in two, if they are few; else the best of
    some seeded random codes, by the distance of the closest rows.
    """
    if count < 2:
        return np.ones((count, 0), np.int8)
    if (1 << (count - 1)) - 1 <= bits:
        splits = [(1, *rest) for rest in product((1, -1), repeat=count - 1)][1:]
        return np.array(splits, np.int8).T
    rng = np.random.default_rng(11)
    best, widest = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (count, bits))
        near = (code.astype(int) @ code.T.astype(int) - 2 * bits * np.eye(count, dtype=int)).max()
        distance = (bits - near) // 2
        if distance > widest and (np.abs(code.sum(0)) < count).all():
            best, widest = code, distance
    return best


@dataclass(frozen=True)
class LanguageModel:
    """``weights``: (n-gram buckets + 1) x bits; ``trust``: languages x bits, each row sums to 1."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether it is ambiguous."""
        points = letters_only(text or "")
        if not len(points) or not self.languages:
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margins = _features(points) @ self.weights[:-1] + self.weights[-1]
        chance, bits_off = self.decode(margins)
        best = int(chance.argmax())
        spare = (min_distance(self.code) - 1) // 2
        return self.languages[best], float(chance[best]), bool(chance[best] < CLEAR or bits_off[best] > spare)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each language's share of the evidence, and how many of its bits are off."""
        agree = self.code * margins
        loss = (self.trust * np.logaddexp(0, -agree)).sum(1) * self.code.shape[1]
        chance = np.exp(loss.min() - loss)
        return chance / chance.sum(), (agree < 0).sum(1)


def min_distance(code: np.ndarray) -> int:
    rows = code.astype(int)
    return int(min((a != b).sum() for i, a in enumerate(rows) for b in rows[:i]))


def _features(points: np.ndarray) -> np.ndarray:
    """Square roots of the n-gram counts, scaled to length 1: long texts don't shout."""
    counts = np.sqrt(np.bincount(buckets(points, SIZES, BITS, False), minlength=1 << BITS).astype(np.float32))
    return counts / np.linalg.norm(counts)


def _fit_arrays(features: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Logistic regressions, one per column of ``bits`` (-1 or 1), fitted together by Adam."""
    weights = np.zeros((features.shape[1] + 1, bits.shape[1]), np.float32)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    # both sides of a bit weigh the same, however many documents they have
    share = np.stack([(bits > 0).mean(0), (bits < 0).mean(0)])
    balance = np.where(bits > 0, 0.5 / np.maximum(share[0], 1e-6), 0.5 / np.maximum(share[1], 1e-6)).astype(np.float32)
    scale = 10.0  # features have length 1; this lets small weights separate
    for step in range(1, STEPS + 1):
        margins = scale * (features @ weights[:-1]) + weights[-1]
        off = -bits * balance / (1 + np.exp(np.clip(bits * margins, -30, 30)))
        slope = np.concatenate([scale * (features.T @ off), off.sum(0, keepdims=True)]) / len(bits)
        slope[:-1] += 1e-3 * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    weights[:-1] *= scale
    return weights


def fit_languages(
    df: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> LanguageModel:
    """Fit on about ``per_language`` documents of each language for which ``usable`` holds.

    The sample is the documents with the smallest hashes of id and text: the
    share of a language that gives the wanted number on average, twice that at
    most. Rows without text or language are left out. A sample without any gives
    a model that answers ``und``.
    """
    rows = df if usable is None else df.where(usable)
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return LanguageModel((), codewords(0), np.zeros((1, 0), np.float32), np.zeros((0, 0)))
    part = F.lit(0.0)
    for lang, n in sizes.items():
        part = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(part)
    place = F.pmod(F.xxhash64(F.lit("lang"), "id", "text"), F.lit(1_000_003)) / 1_000_003
    sample = rows.where(place < part).limit(2 * per_language * len(languages))
    number = {lang: k for k, lang in enumerate(languages)}

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if len(points := letters_only(text)):
                    x = _features(points)
                    yield pa.RecordBatch.from_pydict({"k": [number[lang]], "x": [x.astype(np.float16).tobytes()]})

    found = sample.select("lang", "text").mapInArrow(featured, "k long, x binary").toArrow()
    if not len(found):
        return LanguageModel((), codewords(0), np.zeros((1, 0), np.float32), np.zeros((0, 0)))
    # a fixed order, so that a rerun fits the same model
    made = sorted(zip(found.column("k").to_pylist(), found.column("x").to_pylist(), strict=True))
    kinds = sorted({k for k, _ in made})
    languages = tuple(languages[k] for k in kinds)
    owner = np.array([kinds.index(k) for k, _ in made])
    features = np.stack([np.frombuffer(x, np.float16) for _, x in made]).astype(np.float32)
    code = codewords(len(languages))
    bits = code[owner].astype(np.float32)
    weights = _fit_arrays(features, bits)
    right = ((features @ weights[:-1] + weights[-1]) * bits > 0).astype(float)
    trust = np.stack([right[owner == k].mean(0) for k in range(len(languages))]) + 1e-3
    return LanguageModel(languages, code, weights, trust / np.maximum(trust.sum(1, keepdims=True), 1e-9))


def identify_languages(df: DataFrame, model: LanguageModel, text_col: str = "text", out: str = "language") -> DataFrame:
    """``df`` with a struct column ``out`` of ``lang``, ``score`` and ``ambiguous``.

    Whole texts are read. Null texts and texts without a letter are ``und`` with
    score 0; so is every text if the model has no language. Repeated rows get
    the same answer. A column named ``out`` is replaced, all others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    @F.arrow_udf("struct<lang:string,score:double,ambiguous:boolean>")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for texts in batches:
            found = [known.predict(t.as_py()) for t in texts]
            yield pa.array([dict(zip(("lang", "score", "ambiguous"), f, strict=True)) for f in found], kind)

    made = free_name(df, "__language")
    kept = [f"`{c}`" for c in df.columns if c.lower() != out.lower()]
    return df.withColumn(made, identify(F.col(text_col))).select(*kept, F.col(made).alias(out))
