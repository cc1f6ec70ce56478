"""Amount texts to doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITESPACE = " \t\r\n\x0b\x0c"
# The JVM's number parser also takes type suffixes ("10d") and hexadecimal
# floats, which are not amounts. The "f" of "inf" is no suffix.
_JVM_ONLY = r"[xX]|(?<![nN])[dDfF]$"


def _trimmed(text: Column) -> Column:
    return F.nullif(F.btrim(text, F.lit(_WHITESPACE)), F.lit(""))


def _number(trimmed: Column) -> Column:
    return F.when(~trimmed.rlike(_JVM_ONLY), trimmed.try_cast("double"))


def is_number(text: Column) -> Column:
    """True where ``text`` is missing, blank or a number."""
    trimmed = _trimmed(text)
    return trimmed.isNull() | _number(trimmed).isNotNull()


def parse_amount(text: Column, label: str, on_error: str = "fail") -> Column:
    """Trim, read blank or missing as 0.0, cast to double.

    A text that is no number raises with ``on_error="fail"`` and counts as 0.0
    with ``on_error="null"``.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    trimmed = _trimmed(text)
    number = _number(trimmed)
    if on_error == "fail":
        message = F.concat(F.lit(f"{label}: not a number: "), trimmed)
        number = F.when(
            trimmed.isNotNull(), F.coalesce(number, F.raise_error(message).cast("double"))
        )
    return F.coalesce(number, F.lit(0.0))
