"""Column functions: text, dates, amounts and file names."""

from feedlake.functions.dates import date_columns, iso_day, parse_date, parse_date_strict
from feedlake.functions.money import is_number, parse_amount
from feedlake.functions.names import base_name, name_date
from feedlake.functions.text import (
    drop_null_tokens,
    fields,
    first_field,
    repair_literals,
    rest_of_line,
    width,
)

__all__ = [
    "base_name",
    "date_columns",
    "drop_null_tokens",
    "fields",
    "first_field",
    "is_number",
    "iso_day",
    "name_date",
    "parse_amount",
    "parse_date",
    "parse_date_strict",
    "repair_literals",
    "rest_of_line",
    "width",
]
