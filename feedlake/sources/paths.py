"""Paths as readers take them and as listings give them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def reader_paths(paths: Sequence[str] | str) -> list[str]:
    """Paths that a reader takes as they are: characters of glob patterns lose that meaning."""
    paths = [paths] if isinstance(paths, str) else paths
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", path) for path in paths]


def file_path() -> Column:
    """The path of a row's file as listings give it.

    The reader's own column is URL-encoded, so names with a space, ``%`` or
    letters beyond ASCII would not be found among the listed files.
    """
    # a plus sign stands for itself in paths, not for a space
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
