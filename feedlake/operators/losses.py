"""What a load could not read, by file, record type and column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlake.functions.money import is_number
from feedlake.plans.handoff import written

LOSS_KEYS = ("file", "recordtype", "column", "reason")
#: Texts that a summary shows per group.
SHOWN = 3


def lost_date(text: Column, parsed: Column) -> Column:
    """True where a non-empty text was read as no date."""
    return F.coalesce((text != "") & parsed.isNull(), F.lit(False))


def lost_amount(text: Column) -> Column:
    """True where a text that is not blank holds no number."""
    return ~is_number(text)


def lost_values(df: DataFrame, losses: Sequence[tuple[str, str, Column, Column]], by: Sequence[str]) -> DataFrame:
    """One row per lost value: ``by``, ``column``, ``reason`` and the ``text``.

    ``losses`` names a column, a reason, the condition under which a row's value
    is lost, and the text it was read from. Rows without losses give none; a
    null condition counts as false.
    """
    found = (
        F.when(lost, F.struct(F.lit(column).alias("column"), F.lit(reason).alias("reason"), text.alias("text")))
        for column, reason, lost, text in losses
    )
    kept = df.select(*by, F.array_compact(F.array(*found)).alias("_lost"))
    return kept.select(*by, F.inline("_lost"))


def summarise_losses(values: DataFrame, by: Sequence[str] = LOSS_KEYS, shown: int = SHOWN) -> DataFrame:
    """Per group of ``by``: how many values are lost, and the ``shown`` smallest different texts.

    ``values`` is read once: equal texts are counted before they are shuffled,
    by text, and of these counts each task hands on one sum and the smallest
    texts per group, so that no group has to fit into a task. Null texts are
    counted, but not shown; a table without rows gives no groups.
    """
    each = written(values.groupBy(*by, "text").agg(F.count("*").alias("lost")))
    counts = each.groupBy(*by).agg(F.sum("lost").alias("lost"))
    first = Window.partitionBy(*by).orderBy("text")
    places = each.where("text IS NOT NULL").withColumn("_place", F.row_number().over(first))
    smallest = places.where(F.col("_place") <= shown)
    lists = smallest.groupBy(*by).agg(F.array_sort(F.collect_list("text")).alias("texts"))
    lists = lists.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    none = F.array().cast("array<string>")
    return counts.join(lists, same, "left").select(*by, "lost", F.coalesce("texts", none).alias("texts"))


def lost_lines(rejects: DataFrame) -> DataFrame:
    """Refused lines counted per file, record type and reason; their texts are in ``rejects``.

    Notes on lines that were loaded (``amount``) are left out: these lost a value, not the line.
    """
    none = F.lit(None).cast("string")
    return (
        rejects.where("reason != 'amount'")
        .groupBy("file", "recordtype", "reason")
        .agg(F.count("*").alias("lost"))
        .select("file", "recordtype", none.alias("column"), "reason", "lost", F.array().cast("array<string>").alias("texts"))
    )
