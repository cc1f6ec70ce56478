"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file lies; every machine has the package."""
    return public_tokenizers.path(name)


def small_batches(spark: SparkSession) -> None:
    """Texts are long: some hundred rows fill an Arrow batch, more only cost memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def count_words(text: Column) -> Column:
    """Number of words; null counts 0. Each word becomes one letter, so no array of words is built."""
    words = F.regexp_replace(text, r"^[\x20\x09-\x0D]+", "")
    marks = F.regexp_replace(words, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """The texts of a batch in order, some at a time: about ``size`` bytes, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
        yield texts.slice(at, stop - at)
        at = stop


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def smallest_by_hash(df: DataFrame, key: str, limit: int) -> DataFrame:
    """A repeatable sample of at most ``limit`` rows: those with the smallest hash of ``key``.

    Only rows whose hash is small for so many rows are sorted, some three times ``limit``.
    """
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 40))
    rows = df.count()
    if rows > 3 * limit:
        df = df.where(place < int((1 << 40) * 3 * limit / rows))
    return df.orderBy(place, F.col(key)).limit(limit)


#: Bits of an id filter: 4 MB, whatever the number of ids; some 3 million ids give one false hit in a hundred.
FILTER_BITS = 25
_FILTER_HASHES = 3


@dataclass(frozen=True)
class IdFilter:
    """A test that every id given to :func:`id_filter` passes, and few others do."""

    table: Broadcast
    size: int

    def places(self, column: Column) -> Column:
        """Where the filter looks for an id, as an array; :meth:`hits` takes it in a task."""
        return _places(column, self.size)

    def hits(self, places: pa.ListArray) -> np.ndarray:
        at = places.flatten().to_numpy()
        hit = (self.table.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return hit.reshape(-1, _FILTER_HASHES).all(1)

    def passes(self, column: Column) -> Column:
        @F.arrow_udf("boolean")
        def test(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for lists in batches:
                yield pa.array(self.hits(lists))

        return test(self.places(column))


def _places(column: Column, size: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(k), column), F.lit(size)).cast("int") for k in range(_FILTER_HASHES)])


def id_filter(ids: DataFrame, bits: int = FILTER_BITS) -> IdFilter:
    """A Bloom filter of the ids in the first column of ``ids``.

    Its size is fixed, so it can go to all tasks however many ids there are;
    with too many of them more rows pass, never fewer. It lets large rows be
    picked without a shuffle of all of them; an exact join of those that pass
    follows where it matters. Null ids pass as any id does.
    """
    size = 1 << bits
    place = ids.select(F.explode(_places(F.col(ids.columns[0]), size)).alias("p"))
    words = place.select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, p & 63)").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(size // 64, np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return IdFilter(ids.sparkSession.sparkContext.broadcast(table), size)
