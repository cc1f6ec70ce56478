"""What file names and paths say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.constants import DAY_FORMAT
from feedlake.functions.dates import parse_date


def base_name(path: Column) -> Column:
    """Last part of a path."""
    return F.substring_index(path, "/", -1)


def name_date(name: Column) -> Column:
    """Snapshot date in a payload's name: the eight digits before its suffix.

    One more character may stand between the digits and the suffix.
    """
    digits = F.regexp_extract(name, r"([0-9]{8}).?[.]pgp$", 1)
    return parse_date(digits, DAY_FORMAT)
