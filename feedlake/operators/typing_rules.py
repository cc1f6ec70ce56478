"""Typing of text columns by name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.constants import MONEY_COLUMNS, RECORD_DATE_FORMATS, STAMP_FORMAT
from feedlake.functions.dates import date_columns, parse_date, parse_date_strict, parses
from feedlake.functions.money import is_number, parse_amount
from feedlake.operators.unpack import FILE_AND_TYPE
from feedlake.plans.handoff import written


def coerce_dates(
    df: DataFrame, cols: Sequence[str] | None = None, pattern: str = STAMP_FORMAT
) -> DataFrame:
    """Parse under one pattern; a text that does not match is null."""
    cols = date_columns(df.columns) if cols is None else cols
    return df.withColumns({c: parse_date(F.col(c), pattern) for c in cols})


def format_ok(df: DataFrame, cols: Sequence[str], pattern: str, by: Sequence[str]) -> DataFrame:
    """Per group and column: does every non-empty text match ``pattern``."""
    return df.groupBy(*by).agg(*(F.bool_and(parses(F.col(c), pattern)).alias(c) for c in cols))


def _last_choice(text: Column, pattern: str, label: str, last: str) -> Column:
    return parse_date_strict(text, pattern, label) if last == "fail" else parse_date(text, pattern)


def date_choice(
    text: Column, first_fits: Column | bool, formats: Sequence[str], label: str, last: str
) -> Column:
    """``text`` under the first format where it fits the group, else under the second.

    ``first_fits`` may be known when the plan is built: then only that format
    is in the plan.
    """
    first, second = formats
    if first_fits is True:
        return parse_date(text, first)
    second_choice = _last_choice(text, second, label, last)
    if first_fits is False:
        return second_choice
    return F.when(first_fits, parse_date(text, first)).otherwise(second_choice)


def parse_dates_column(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    formats: Sequence[str] = RECORD_DATE_FORMATS,
    by: Sequence[str] = FILE_AND_TYPE,
    last: str = "coerce",
    scope: str = "column",
) -> DataFrame:
    """Parse date columns under the first of two formats, or else the second.

    ``scope="column"``: the first format is used for a column of a group only if
    all its non-empty texts match it; one other text moves the whole column of
    that group to the second format. ``last`` says what becomes of a text that
    does not match the second: null (``"coerce"``) or an error (``"fail"``).
    ``scope="row"`` decides text by text, which loses nothing.
    """
    if last not in ("coerce", "fail"):
        raise ValueError(f"last must be 'coerce' or 'fail', not {last!r}")
    cols = date_columns(df.columns) if cols is None else list(cols)
    first, second = formats
    if scope == "row":
        return df.withColumns(
            {
                c: F.coalesce(
                    parse_date(F.col(c), first), _last_choice(F.col(c), second, c, last)
                )
                for c in cols
            }
        )
    if scope != "column":
        raise ValueError(f"scope must be 'column' or 'row', not {scope!r}")
    if not cols:
        return df
    verdicts = format_ok(df, cols, first, by).withColumnsRenamed({c: f"_ok_{c}" for c in cols})
    return apply_formats(df, written(verdicts), cols, formats, by, last)


def apply_formats(
    df: DataFrame,
    verdicts: DataFrame,
    cols: Sequence[str],
    formats: Sequence[str],
    by: Sequence[str],
    last: str,
) -> DataFrame:
    """Parse ``cols`` as the verdicts say: ``_ok_<column>`` per group of ``by``.

    What all groups agree on goes into the plan as a constant; the rows are
    joined with the verdicts (a written table, one row per group) only where
    groups differ.
    """
    agreed = _agreement(verdicts, cols)
    mixed = [c for c in cols if agreed[c] is None]
    out = df
    if mixed:
        keep = verdicts.select(
            *(F.col(c).alias(f"_by_{c}") for c in by), *(f"_ok_{c}" for c in mixed)
        )
        same = [df[c].eqNullSafe(keep[f"_by_{c}"]) for c in by]
        out = df.join(keep, same)
    fits: Mapping[str, Column | bool] = {
        c: F.col(f"_ok_{c}") if agreed[c] is None else agreed[c] for c in cols
    }
    typed = {c: date_choice(F.col(c), fits[c], formats, c, last) for c in cols}
    return out.select(*(typed[c].alias(c) if c in typed else F.col(c) for c in df.columns))


def _agreement(verdicts: DataFrame, cols: Sequence[str]) -> dict[str, bool | None]:
    """Per column the verdict of all groups, or None where they differ."""
    if not cols:
        return {}
    row = verdicts.agg(
        *(F.bool_and(f"_ok_{c}").alias(f"all_{c}") for c in cols),
        *(F.bool_or(f"_ok_{c}").alias(f"any_{c}") for c in cols),
    ).first()
    return {
        c: True if row[f"all_{c}"] in (True, None) else (False if not row[f"any_{c}"] else None)
        for c in cols
    }


def money_columns(names: Iterable[str]) -> list[str]:
    """Those of ``names`` that hold amounts in the placement feed."""
    return [name for name in names if name in MONEY_COLUMNS]


def parse_doubles(df: DataFrame, cols: Sequence[str], on_error: str = "fail") -> DataFrame:
    """Amounts to doubles: blank and missing are 0.0, other texts are errors or 0.0."""
    return df.withColumns({c: parse_amount(F.col(c), c, on_error) for c in cols})


def bad_amounts(cols: Sequence[str]) -> Column:
    """Names of the amount columns of a row that hold no number."""
    names = (F.when(~is_number(F.col(c)), F.lit(c)) for c in cols)
    return F.array_compact(F.array(*names))
