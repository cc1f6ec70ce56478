"""Types of text columns, found while something else is counted.

Each text has a kind, a bit; a column's state is the bits of its texts. States
merge by bitwise or, in any order and grouping, and the least type that holds
all kinds is read off in the end.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.constants import LONG_FORMAT
from feedlake.functions.dates import parses

WHOLE, REAL, STAMP, TEXT = 1, 2, 4, 8
_REAL = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[iI]nf(?:inity)?)\s*\z"


def kind(text: Column, stamps: bool = False) -> Column:
    """The bit of a text, 0 for null. Whole numbers that a bigint cannot hold are texts."""
    whole = F.trim(text).rlike(r"^[+-]?[0-9]+\z")
    stamp = (F.length(text) == len(LONG_FORMAT)) & parses(text, LONG_FORMAT) if stamps else F.lit(False)
    return (
        F.when(text.isNull(), 0)
        .when(whole, F.when(text.try_cast("bigint").isNotNull(), WHOLE).otherwise(TEXT))
        .when(text.rlike(_REAL), REAL)
        .when(stamp, STAMP)
        .otherwise(TEXT)
    )


def state(text: Column, stamps: bool = False) -> Column:
    """The aggregate of a column's kinds."""
    return F.coalesce(F.bit_or(kind(text, stamps)), F.lit(0))


def least_type(states: Collection[int]) -> str:
    """The least type of the merged states; columns without any text are doubles, as missing numbers are."""
    merged = 0
    for s in states:
        merged |= s
    if merged == WHOLE:
        return "bigint"
    if merged & ~(WHOLE | REAL) == 0:
        return "double"
    return "timestamp_ntz" if merged == STAMP else "string"
