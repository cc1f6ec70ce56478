"""Feed headers and record types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedlake.constants import DAY_FORMAT, FEED_PREFIXES, HDR, SINGLE_TYPE_FEEDS
from feedlake.functions.dates import parse_date
from feedlake.functions.names import name_date
from feedlake.functions.text import first_field, rest_of_line


def prepend_literal(df: DataFrame, name: str, value: str) -> DataFrame:
    """Put a constant column first."""
    return df.select(F.lit(value).alias(name), "*")


def snapshot_from_name(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Add ``snap_dt``, the date in the file's name."""
    return df.withColumn("snap_dt", name_date(F.col(name)))


def first_lines(lines: DataFrame) -> DataFrame:
    """First line of each file of ``(file, block_start, value)`` rows, however it was split.

    This reads all lines; for files on storage ``sniff_first_lines`` does not.
    """
    placed = lines.withColumn("_at", F.struct("block_start", F.monotonically_increasing_id()))
    return placed.groupBy("file").agg(F.min_by("value", "_at").alias("value"))


def feed_header(firsts: DataFrame) -> DataFrame:
    """First lines ``(file, value)`` as ``(file, feed, snap_dt)``.

    ``<feed>|..|<YYYYMMDD>``, or ``HDR|<feed>|<YYYYMMDD...>`` of which the
    first eight characters count. ``snap_dt`` is null for a bad date.
    """

    def part(n: int) -> Column:
        return F.split_part("value", F.lit("|"), F.lit(n))

    second_kind = part(1) == HDR
    day = F.when(second_kind, F.substring(part(3), 1, 8)).otherwise(part(3))
    return firsts.select(
        "file",
        F.when(second_kind, part(2)).otherwise(part(1)).alias("feed"),
        parse_date(day, DAY_FORMAT).alias("snap_dt"),
    )


def attach_header(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Give each line the feed and snapshot date of its file.

    ``headers`` has one row per file. Hand it over as a written table (see
    ``plans.handoff``): Catalyst then knows its size and broadcasts it only
    while it is small.
    """
    return lines.join(headers, "file")


def tag_single(df: DataFrame) -> DataFrame:
    """Single-type feed: the feed is the record type, the line is the body."""
    return df.withColumns({"recordtype": F.col("feed"), "custom": F.col("value")})


def tag_multi(df: DataFrame) -> DataFrame:
    """Multi-type feed: the first field is the record type, the rest the body."""
    value = F.col("value")
    return df.withColumns({"recordtype": first_field(value), "custom": rest_of_line(value)})


def is_single_type(feed: Column) -> Column:
    """True for the feeds that hold one record type only."""
    return feed.isin(*SINGLE_TYPE_FEEDS)


def _names_feed(anchored: bool) -> Column:
    if not anchored:
        return F.contains("value", "feed")
    header = F.split_part("value", F.lit("|"), F.lit(1))
    second = F.split_part("value", F.lit("|"), F.lit(2))
    return (header == F.col("feed")) | ((header == HDR) & (second == F.col("feed")))


def strip_header_contains(df: DataFrame, anchored: bool = False) -> DataFrame:
    """Single-type feed: drop the lines that name the feed anywhere.

    With ``anchored`` only lines in the shape of a header are dropped.
    """
    return df.where(~_names_feed(anchored))


def strip_header_type(df: DataFrame) -> DataFrame:
    """Multi-type feed: drop the lines whose record type is the feed's name."""
    return df.where(F.col("recordtype") != F.col("feed"))


def feed_details(headers: DataFrame, prefixes: Mapping[str, str] = FEED_PREFIXES) -> DataFrame:
    """Add what else the feed's name tells: ``prefix`` of its registry keys and ``lead``.

    ``lead`` is the number of fields of a line before the body: none in a
    single-type feed, the record type in others. Worked out once per file, so
    that nothing of it is left to do per line.
    """
    known = F.create_map(*(F.lit(text) for pair in prefixes.items() for text in pair))
    return headers.select(
        "file",
        "feed",
        "snap_dt",
        F.try_element_at(known, F.col("feed")).alias("prefix"),
        F.when(is_single_type(F.col("feed")), 0).otherwise(1).alias("lead"),
    )


def tag_lines(
    df: DataFrame, anchored: bool = False, dropped: Observation | None = None
) -> DataFrame:
    """Record types of the lines of feeds of both kinds, without their headers, in one pass.

    Same rows and record types as ``tag_single`` + ``strip_header_contains``
    for single-type feeds and ``tag_multi`` + ``strip_header_type`` for others
    (see ``feed_details`` for ``lead``). The line stays whole. ``dropped`` counts
    the lines that go because they name the feed, without being headers (``named``).
    """
    single, feed = F.col("lead") == 0, F.col("feed")
    recordtype = F.when(single, feed).otherwise(first_field(F.col("value")))
    header = F.when(single, _names_feed(anchored)).otherwise(recordtype == feed)
    if dropped is not None:
        df = df.observe(dropped, F.count_if(single & header & ~_names_feed(True)).alias("named"))
    return df.where(~header).withColumn("recordtype", recordtype)


def record_types(df: DataFrame) -> DataFrame:
    """The record types of each file."""
    return df.select("file", "recordtype").distinct()


def demux(df: DataFrame, recordtype: str) -> DataFrame:
    """Rows of one record type; on a table partitioned by it, its folder only."""
    return df.where(F.col("recordtype") == recordtype)


def stamp_snapshot(df: DataFrame, day: Column) -> DataFrame:
    """Append ``snap_dt`` parsed from a ``YYYYMMDD`` text."""
    return df.withColumn("snap_dt", parse_date(day, DAY_FORMAT))
