"""A day's files, as a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.constants import QUEUE_NAME_PART, REPAIR_NAME_PART
from feedlake.functions.names import base_name


def discover(
    spark: SparkSession, dirs: Mapping[str, str], syncday: str, suffix: str | Sequence[str]
) -> DataFrame:
    """Files named ``*<syncday>*<suffix>`` in the folders of several sources.

    ``dirs`` maps a source's name to its folder; several suffixes are listed in
    one go. Only the listing is read: the file contents are never selected, so
    no data block is opened. An empty file is given the start of the epoch as
    its modification time.
    """
    suffixes = (suffix,) if isinstance(suffix, str) else tuple(suffix)
    glob = f"*{syncday}*{{{','.join(suffixes)}}}"
    filled, names = [], []
    for source, folder in dirs.items():
        listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
        filled.append(
            listed.select(
                F.lit(source).alias("source"),
                base_name(F.col("path")).alias("name"),
                "path",
                "length",
                "modificationTime",
            )
        )
        # Spark's file scans leave out empty files, and markers mostly are
        # empty: all names come from the listing the reader has made.
        names += [
            (source, unquote(path.rsplit("/", 1)[-1]), folder.rstrip("/") + "/")
            for path in listed.inputFiles()
        ]
    named = spark.createDataFrame(names, "source string, name string, folder string")
    kept_suffix = F.coalesce(*(F.when(F.endswith("name", F.lit(s)), s) for s in suffixes))
    return named.join(union_sources(*filled), ["source", "name"], "left").select(
        "source",
        F.coalesce("path", F.concat("folder", "name")).alias("path"),
        "name",
        kept_suffix.alias("suffix"),
        F.coalesce("length", F.lit(0)).alias("length"),
        F.coalesce("modificationTime", F.timestamp_seconds(F.lit(0))).alias("modificationTime"),
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of several sources; duplicates are kept."""
    return reduce(DataFrame.unionByName, frames)


def route_kind(files: DataFrame, name: str = "name") -> DataFrame:
    """Add ``kind`` (``queue`` or ``feed``) and ``repair`` by parts of the name."""
    file_name = F.col(name)
    queue = file_name.contains(QUEUE_NAME_PART)
    return files.withColumns(
        {
            "kind": F.when(queue, "queue").otherwise("feed"),
            "repair": ~queue & file_name.contains(REPAIR_NAME_PART),
        }
    )
