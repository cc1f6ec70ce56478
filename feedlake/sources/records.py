"""Delimited records whose quoted fields go over several lines, from files that are still cut into splits.

Whether a line ends inside quotes depends on whether it began inside. So each
line is a function of that, two answers, and a split's lines together are one,
too. A pass over these answers alone gives the function of every split; folded
over a file's splits in order they tell which ones begin inside quotes, and
where the record they continue began. With that known every split joins its
lines into records by itself, and only the pieces of records that go over a
border of splits meet again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.plans.handoff import written
from feedlake.sources.paths import file_path, reader_paths


def _opened(sep: str) -> tuple[str, str]:
    """Expressions for lines that end inside quotes: when they begin outside, and when they begin inside.

    A quote opens a field only as its first character; two in a row inside are
    one. Loops are possessive, so a line may be long.
    """
    if len(sep) != 1:
        raise ValueError(f"a separator of one character is needed, not {sep!r}")
    s = re.escape(sep)
    inner = '(?:[^"]|"")*+'
    field = f'(?:"{inner}"[^{s}]*+|[^"{s}][^{s}]*+|)'
    opens = f'(?:{field}{s})*+"{inner}$'
    return f"^{opens}", f'^{inner}(?:$|"[^{s}]*+{s}{opens})'


def _lines(spark: SparkSession, paths: Sequence[str] | str, sep: str) -> DataFrame:
    """Every line, blank ones too, with its file, its split and its two answers."""
    outside, inside = _opened(sep)
    quoted = F.contains("value", F.lit('"'))
    return spark.read.text(reader_paths(paths)).select(
        file_path().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        (quoted & F.col("value").rlike(outside)).alias("from_out"),
        (~quoted | F.col("value").rlike(inside)).alias("from_in"),
    )


def has_breaks(spark: SparkSession, paths: Sequence[str] | str, sep: str = "|") -> bool:
    """Whether any line opens a quoted field that it does not close."""
    return bool(_lines(spark, paths, sep).where("from_out").limit(1).count())


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """``(file, block, start, end)`` of the runs of lines of one split in a batch."""
    files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
    codes = files.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
    bounds = [0, *cuts.tolist(), batch.num_rows]
    for start, end in zip(bounds, bounds[1:]):
        if start < end:
            yield files.dictionary[codes[start]].as_py(), int(blocks[start]), start, end


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: how it ends when it begins outside, when it begins inside, and whether a line of it begins outside then."""
    key, ends, free = None, [False, True], False

    def row() -> pa.RecordBatch:
        told = [[key[0]], [key[1]], [ends[0]], [ends[1]], [free]]
        return pa.RecordBatch.from_arrays([pa.array(t) for t in told], ["file", "block", "from_out", "from_in", "free"])

    for batch in batches:
        out, into = batch.column("from_out").to_numpy(zero_copy_only=False), batch.column("from_in").to_numpy(zero_copy_only=False)
        for file, block, start, end in _runs(batch):
            if key != (file, block):
                if key:
                    yield row()
                key, ends, free = (file, block), [False, True], False
            free = free or not ends[1]  # its first line here begins outside
            # other lines leave things as they are
            for k in np.flatnonzero(out[start:end] | ~into[start:end]) + start:
                ends = [bool(into[k] if e else out[k]) for e in ends]
                free = free or (not ends[1] and k < end - 1)
    if key:
        yield row()


def _begun_inside(splits: DataFrame) -> dict[tuple[str, int], int]:
    """The splits that begin inside quotes, with the split in which that record began; a row per such split."""
    ordered = splits.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "from_out", "from_in", "free"))).alias("s"))
    state = F.struct(F.lit(False).alias("inside"), F.lit(-1).cast("long").alias("home"), F.array().cast("array<struct<block:long,home:long>>").alias("found"))

    def step(a: Column, s: Column) -> Column:
        found = F.when(a["inside"], F.array_append(a["found"], F.struct(s["block"].alias("block"), a["home"].alias("home")))).otherwise(a["found"])
        # unless the whole split is inside one record, a record still open at its end began in it
        home = F.when(a["inside"] & ~s["free"], a["home"]).otherwise(s["block"])
        return F.struct(F.when(a["inside"], s["from_in"]).otherwise(s["from_out"]).alias("inside"), home.alias("home"), found.alias("found"))

    told = ordered.select("file", F.explode(F.aggregate("s", state, step, lambda a: a["found"])).alias("f"))
    return {(r.file, r.block): r.home for r in told.select("file", "f.block", "f.home").toLocalIterator()}


def quoted_records(spark: SparkSession, paths: Sequence[str] | str, sep: str = "|") -> DataFrame:
    """``(file, value)``: the non-blank records, those of several lines joined by line feeds."""
    lines = _lines(spark, paths, sep)
    told = "file string, block long, from_out boolean, from_in boolean, free boolean"
    splits = written(lines.select("file", "block", "from_out", "from_in").mapInArrow(_folded, told))
    begun = spark.sparkContext.broadcast(_begun_inside(splits))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, home, open_lines = None, False, 0, []

        def made(rows: list[tuple[str, int, int, str, bool]]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "home", "block", "value", "whole"])

        for batch in batches:
            out, into = batch.column("from_out").to_pylist(), batch.column("from_in").to_pylist()
            values, rows = batch.column("value").to_pylist(), []
            for file, block, start, end in _runs(batch):
                if key != (file, block):
                    if open_lines:  # the split ends inside a record
                        rows.append((*key[:1], home, key[1], "\n".join(open_lines), False))
                    key, open_lines = (file, block), []
                    inside, home = key in begun.value, begun.value.get(key, block)
                for k in range(start, end):
                    if not inside:
                        home = block
                    open_lines.append(values[k])
                    inside = into[k] if inside else out[k]
                    if not inside:
                        rows.append((file, home, block, "\n".join(open_lines), home == block))
                        open_lines = []
            yield made(rows)
        if open_lines:
            yield made([(key[0], home, key[1], "\n".join(open_lines), False)])

    schema = "file string, home long, block long, value string, whole boolean"
    pieces = written(lines.mapInArrow(joined, schema), partition_by=("whole",))
    whole = pieces.where("whole").select("file", "value")
    # pieces of one record: as many as there are splits that it touches
    cut = pieces.where("NOT whole").groupBy("file", "home").agg(F.array_sort(F.collect_list(F.struct("block", "value"))).alias("p"))
    cut = cut.select("file", F.array_join(F.transform("p", lambda p: p["value"]), "\n").alias("value"))
    return whole.unionByName(cut).where(F.trim("value") != "")
