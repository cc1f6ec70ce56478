"""Did the day's files arrive, and which of them are still to be loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.constants import (
    EXPECTED_PAYLOADS,
    EXPECTED_PAYLOADS_BUSY,
    MARKER_SUFFIX,
    MIN_MARKERS,
    PAYLOAD_SUFFIX,
    SECOND_SOURCE_BUSY,
)


def _is_marker() -> Column:
    return F.col("suffix") == MARKER_SUFFIX


def _is_payload() -> Column:
    return F.col("suffix") == PAYLOAD_SUFFIX


def arrival_counts(files: DataFrame) -> DataFrame:
    """Markers and payloads per source, and in total (``source`` null)."""
    return files.rollup("source").agg(
        F.count_if(_is_marker()).alias("markers"), F.count_if(_is_payload()).alias("payloads")
    )


def completeness(
    files: DataFrame,
    second_source: str,
    by: Sequence[str] = (),
    strict_markers: bool = False,
) -> DataFrame:
    """One verdict over all files, or one for each group of ``by``.

    ``ok``: enough markers. ``ok_without_markers``: too few markers, but just
    the expected number of payloads, which is higher on days when the second
    source delivers many. ``incomplete`` otherwise. With ``strict_markers``
    only the markers count.
    """
    counts = files.groupBy(*by).agg(
        F.count_if(_is_marker()).alias("markers"),
        F.count_if(_is_payload()).alias("payloads"),
        F.count_if(_is_payload() & (F.col("source") == second_source)).alias("second_payloads"),
    )
    busy = F.col("second_payloads") >= SECOND_SOURCE_BUSY
    expected = F.when(busy, EXPECTED_PAYLOADS_BUSY).otherwise(EXPECTED_PAYLOADS)
    status = F.when(F.col("markers") >= MIN_MARKERS, "ok")
    if not strict_markers:
        status = status.when(F.col("payloads") == F.col("expected"), "ok_without_markers")
    return counts.withColumn("expected", expected).withColumn(
        "status", status.otherwise("incomplete")
    )


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that no successful load of the ledger has taken in this version."""
    return files.join(_taken(ledger), _VERSION, "left_anti")


def mark_fresh(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """All files, with ``fresh`` true for those that are pending."""
    taken = _taken(ledger).withColumn("_taken", F.lit(True))
    marked = files.join(taken, _VERSION, "left")
    return marked.withColumn("fresh", F.col("_taken").isNull()).drop("_taken")


_VERSION = ["path", "modificationTime"]


def _taken(ledger: DataFrame) -> DataFrame:
    # One row per version before the join: repeated loads of one file would
    # otherwise pile up on its key. The join reuses this partitioning.
    return ledger.where(F.col("status") == "ok").select(*_VERSION).distinct()
