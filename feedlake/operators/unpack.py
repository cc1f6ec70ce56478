"""Body text to named columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.text import fields, width
from feedlake.plans.handoff import written

FILE_AND_TYPE = ("file", "recordtype")


class WidthError(ValueError):
    """A record type of a file does not have the registered number of fields."""


def unpack(df: DataFrame, names: Sequence[str], text: str = "custom", lead: int = 0) -> DataFrame:
    """Split ``text`` and name its fields by position; ``text`` is dropped.

    The first ``lead`` fields are skipped. Missing fields are null and fields
    beyond the last name are ignored; which widths are acceptable is
    ``width_guard``'s matter.
    """
    kept = [c for c in df.columns if c != text]
    # The split is used once per name, so Catalyst keeps it in its own projection.
    split = df.select(*kept, fields(F.col(text)).alias("_fields"))
    named = {n: F.get("_fields", F.lit(i)).alias(n) for i, n in enumerate(names, start=lead)}
    # A registered name that the table already has replaces that column.
    replaced = [named.pop(c) if c in named else F.col(c) for c in kept]
    return split.select(*replaced, *named.values())


def split_width(df: DataFrame, by: Sequence[str] = FILE_AND_TYPE) -> DataFrame:
    """Fields of the widest row of each group."""
    return df.groupBy(*by).agg(F.max(width(F.col("custom"))).alias("width"))


def width_ok(widest: Column, n: Column | int, allow_extra: Column | int = 0) -> Column:
    """The widest row must have ``n`` fields, or up to ``allow_extra`` more."""
    n = F.lit(n) if isinstance(n, int) else n
    extra = F.lit(allow_extra) if isinstance(allow_extra, int) else allow_extra
    return widest.between(n, n + extra)


def width_guard(
    df: DataFrame,
    n: int,
    allow_extra: int = 0,
    by: Sequence[str] = FILE_AND_TYPE,
    mode: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Accept or refuse whole groups by the width of their widest row.

    Returns ``(accepted, rejected)``; ``rejected`` has a ``reason``. With
    ``mode="fail"`` any refused group raises :class:`WidthError` instead. The
    widths are aggregated first and handed over as a table with one row per
    group, and the rows are joined only if some group is to be refused.
    """
    if mode not in ("fail", "reject"):
        raise ValueError(f"mode must be 'fail' or 'reject', not {mode!r}")
    widths = split_width(df, by)
    bad = written(widths.where(~width_ok(F.col("width"), n, allow_extra)))
    shown = bad.limit(5).collect()
    if shown and mode == "fail":
        found = "; ".join(f"{[row[c] for c in by]} has {row['width']} fields" for row in shown)
        raise WidthError(f"expected {n} fields (+{allow_extra}): {found}")
    reason = F.lit("width").alias("reason")
    if not shown:
        return df, df.select("*", reason).limit(0)
    keys = bad.select(*(F.col(c).alias(f"_by_{c}") for c in by))
    same = [df[c].eqNullSafe(keys[f"_by_{c}"]) for c in by]
    return df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi").select("*", reason)
