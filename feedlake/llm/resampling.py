"""Documents that resemble a target collection, by importance resampling.

Texts are bags of hashed word n-grams. The ratio of a bucket's share in the
target to its share in the corpus is its gain; a document's weight is the mean
gain of its n-grams. Gumbel noise, made of the id alone, is added to the
weights, and the documents with the highest sums are a sample without
replacement in proportion to the ratios.

The texts are taken apart by Arrow kernels and never become Python strings:
lower-casing, a split, one flat list of words, a dictionary. N-grams are made of
dictionary indices and the indices behind them, so that only distinct pairs are
spelled out and hashed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlake.plans.handoff import written

from .common import slices

#: What stands between words: ASCII other than digits and (lower-case) letters.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
#: Gains, weights and noise are whole thousandths of their logarithms.
UNIT = 1000
#: Bytes of text that are taken apart at a time.
PORTION = 1 << 22


def hashed_ngrams(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the bucket of every n-gram, and the number of its text in ``texts``; ascending by text."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), APART)
    coded = pc.dictionary_encode(pc.list_flatten(pieces))
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    words = coded.dictionary
    filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # a split leaves empty pieces at the ends
    index = coded.indices.to_numpy(zero_copy_only=False)
    real = filled[index]
    index, owner = index[real].astype(np.int64), pc.list_parent_indices(pieces).to_numpy()[real]
    codes, names, place = index, words, np.arange(len(index))
    for n in range(1, longest + 1):
        if n > 1:
            behind = place + n - 1
            inside = behind < len(index)
            inside[inside] = owner[behind[inside]] == owner[place[inside]]
            codes, place, behind = codes[inside], place[inside], behind[inside]
            pairs, codes = np.unique(codes * len(words) + index[behind], return_inverse=True)
            names = pc.binary_join_element_wise(names.take(pa.array(pairs // len(words))), words.take(pa.array(pairs % len(words))), " ")
        hashes = np.fromiter(map(zlib.crc32, names.cast(pa.binary()).to_pylist()), np.int64, len(names))
        yield (hashes % buckets).take(codes), owner[place]


def bucket_counts(df: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: how many n-grams of up to ``longest`` words all texts hold in each bucket, repeats counted.

    A task adds up its texts before anything is shuffled, so it hands on no more than ``buckets`` rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in slices(batch.column(0), PORTION):
                for bucket, _ in hashed_ngrams(texts, longest, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(there, pa.int32()), "n": pa.array(total[there])})

    parts = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket from two tables of :func:`bucket_counts`; add-one smoothed, ``buckets`` numbers."""
    s, t = (np.zeros(buckets) for _ in range(2))
    for counts, table in ((s, corpus), (t, target)):
        found = table.toArrow()
        counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return np.floor(UNIT * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise that depends on the id and the seed alone, in thousandths; a null id counts as an empty one."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    number = F.conv(F.substr(F.sha2(told, 256), F.lit(1), F.lit(8)), 16, 10).cast("long")
    return F.floor(-UNIT * F.log(-F.log((number + 0.5) / 4294967296.0))).cast("long")


def weighed(df: DataFrame, gains: np.ndarray, id_col: str, text_col: str, longest: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row; the weight is the floored mean gain, 0 without n-grams."""
    shared = df.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text"), PORTION):
                features, words, total = (np.zeros(len(texts), np.int64) for _ in range(3))
                for n, (bucket, owner) in enumerate(hashed_ngrams(texts, longest, len(table)), 1):
                    counts = np.bincount(owner, minlength=len(texts))
                    features += counts
                    if n == 1:
                        words = counts
                    if len(owner):
                        first = np.flatnonzero(np.diff(owner, prepend=-1))
                        total[owner[first]] += np.add.reduceat(table.take(bucket), first)
                columns = [batch.column("doc_id").slice(at, len(texts)), words, features, total // np.maximum(features, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "n_words", "n_features", "weight"])
                at += len(texts)

    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... for the highest scores of ``percent`` % of the eligible rows, null for all others.

    ``scored`` is a written table. Scores are whole numbers, so counts per score
    say which rows stand before all of one score; rows of one score are put in
    order among themselves, and no task ranks more than those.
    """
    counts = written(scored.where(eligible).groupBy("score").agg(F.count("*").alias("n")))
    wanted = percent * (counts.agg(F.sum("n")).first()[0] or 0) // 100
    # a row per distinct score, which the range of the logarithms bounds
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("score").alias("_score"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("_before"))
    before = written(before.where(F.col("_before") < wanted))
    near = scored.join(before, eligible & (F.col("score") == F.col("_score")), "left")
    same = Window.partitionBy("_score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "n_words")
    rank = F.col("_before") + F.row_number().over(same)
    drawn = near.where("_before IS NOT NULL").withColumn("rank", rank)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")).cast("long"))
    rest = near.where("_before IS NULL").withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("_score", "_before")


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each row of ``df``.

    ``percent`` % of the documents with ``least_words`` words or more are drawn,
    those with the highest scores; ``rank`` is their place, and null for all
    others. Ties go to the smaller id (null last), then to fewer n-grams. Null
    and empty texts have no n-grams and the weight 0. Rows with one id are
    documents of their own with the same noise. Without target texts, or without
    documents, all is smoothed and nothing fails. Texts are read whole, twice;
    other columns are not used.
    """
    gains = bucket_gains(
        bucket_counts(df, text_col, longest, buckets), bucket_counts(target, target_col, longest, buckets), buckets
    )
    scored = weighed(df, gains, id_col, text_col, longest)
    scored = written(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    return ranked(scored, F.col("n_words") >= least_words, percent)
