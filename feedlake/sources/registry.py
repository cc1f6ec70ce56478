"""The schema registry: record type to ordered column names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.constants import ENVELOPE_COLUMNS, FEED_PREFIXES, QUEUE_KEY
from feedlake.plans.handoff import from_driver

Registry = Mapping[str, Sequence[str]]


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(key, names)`` of a JSON object whose values are lists of names.

    A name may carry a type after a colon (``"queueid:bigint"``); without one
    the column is text.
    """
    parsed = F.from_json("value", "map<string,array<string>>")
    return spark.read.text(path, wholetext=True).select(F.explode(parsed).alias("key", "names"))


def registry_entries(registry: DataFrame) -> dict[str, list[str]]:
    """The registry on the driver; it has one row per record type.

    A list that names a column twice, or two columns that differ only in case,
    is refused: no table can have both.
    """
    entries = {row.key: list(row.names) for row in registry.collect()}
    for key, names in entries.items():
        lowered = [name.partition(":")[0].lower() for name in names]
        twice = sorted({name for name in lowered if lowered.count(name) > 1})
        if twice:
            raise ValueError(f"the registry entry {key!r} names {', '.join(twice)} more than once")
    return entries


def registry_key(feed: Column, recordtype: Column, prefixes: Mapping[str, str] = FEED_PREFIXES) -> Column:
    """Key of a feed's record type; null for an unknown feed."""
    known = F.create_map(*(F.lit(text) for pair in prefixes.items() for text in pair))
    prefix = F.try_element_at(known, feed)
    return F.when(feed == QUEUE_KEY, F.lit(QUEUE_KEY)).when(
        recordtype != "", F.concat(prefix, F.lower(recordtype))
    )


def prune_schema(names: Iterable[str], exclude: Iterable[str] = ENVELOPE_COLUMNS) -> list[str]:
    """Names without the excluded ones, in order."""
    excluded = set(exclude)
    return [name for name in names if name not in excluded]


def split_types(names: Iterable[str]) -> dict[str, str]:
    """``name:type`` entries as a mapping; plain names are text."""
    return {n: t or "string" for n, _, t in (entry.partition(":") for entry in names)}


def schema_for(
    df: DataFrame,
    registry: DataFrame,
    feed: str = "feed",
    recordtype: str = "recordtype",
    exclude: Sequence[str] = ENVELOPE_COLUMNS,
) -> DataFrame:
    """Add ``key`` and ``names`` (pruned) to each row; both null when unregistered.

    The registry is collected once (one row per record type), pruned and joined
    as a lookup table; the rows of ``df`` are not shuffled for it.
    """
    rows = [(k, prune_schema(v, exclude)) for k, v in registry_entries(registry).items()]
    table = from_driver(df.sparkSession, rows, "key string, names array<string>")
    keyed = df.withColumn("_key", registry_key(F.col(feed), F.col(recordtype)))
    return keyed.join(table, keyed["_key"] == table["key"], "left").drop("_key")
