"""Date texts to zone-less timestamps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.constants import LONG_FORMAT, STAMP_FORMAT

_MONTH = "(?:0[1-9]|1[0-2])"
_DAY = "(?:0[1-9]|1[0-9]|2[0-8])"
_CLOCK = ("(?:[01][0-9]|2[0-3])", "[0-5][0-9]", "[0-5][0-9]")

# Texts of these shapes are dates whatever the month. A check that only asks
# whether a text is a date need not run the much slower datetime parser on them.
_CERTAIN = {
    STAMP_FORMAT: rf"^[12][0-9]{{3}}{_MONTH}{_DAY}{''.join(_CLOCK)}\z",
    LONG_FORMAT: rf"^[12][0-9]{{3}}-{_MONTH}-{_DAY} {':'.join(_CLOCK)}\z",
}


def date_columns(names: Iterable[str]) -> list[str]:
    """Names that hold dates: they contain ``date`` but not ``update``."""
    return [name for name in names if "date" in name and "update" not in name]


def parse_date(text: Column, pattern: str) -> Column:
    """``text`` under ``pattern``; null where it does not match.

    All patterns used here have a fixed width, so a text of another length can
    be refused before the (exception-throwing) datetime parser sees it.
    """
    parsed = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    return F.when(F.length(text) == len(pattern), parsed)


def parse_date_strict(text: Column, pattern: str, label: str) -> Column:
    """As :func:`parse_date`, but a non-empty text that does not match is an error."""
    parsed = parse_date(text, pattern)
    message = F.concat(F.lit(f"{label}: not a date of form {pattern}: "), text)
    return (
        F.when(text.isNull() | (text == ""), F.lit(None).cast("timestamp_ntz"))
        .when(parsed.isNull(), F.raise_error(message).cast("timestamp_ntz"))
        .otherwise(parsed)
    )


def parses(text: Column, pattern: str) -> Column:
    """True where ``text`` is missing, empty or a date under ``pattern``."""
    fits = (F.length(text) == len(pattern)) & F.try_to_timestamp(text, F.lit(pattern)).isNotNull()
    if pattern in _CERTAIN:
        fits = text.rlike(_CERTAIN[pattern]) | fits
    return F.coalesce((text == "") | fits, F.lit(True))


def iso_day(day: Column) -> Column:
    """``YYYYMMDD`` text to ``YYYY-MM-DD`` text."""
    return F.date_format(F.to_date(day, "yyyyMMdd"), "yyyy-MM-dd")
