"""Tables as feed files: the inverse of loading, for round trips and benchmarks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.constants import STAMP_FORMAT


def pack(df: DataFrame, cols: Iterable[str] | None = None, sep: str = "|") -> Column:
    """Columns of ``df`` as one delimited text; timestamps in the stamp layout, null as empty."""

    def text(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, T.TimestampType | T.TimestampNTZType):
            shown = F.date_format(name, STAMP_FORMAT)
        else:
            shown = F.col(name).cast("string")
        return F.coalesce(shown, F.lit(""))

    return F.concat_ws(sep, *(text(name) for name in (cols or df.columns)))


def write_lines(
    df: DataFrame,
    line: Column,
    folder: str,
    header: str | None = None,
    stem: str = "part",
    part: str | None = None,
) -> str:
    """Write a text column as ``.pgp`` files, each of them starting with ``header``.

    Every task writes a file of its own, header first, so nothing is shuffled:
    the writer of delimited files puts the column's name on top of each file.
    With ``part`` the files of each value of that column are in a folder
    ``<part>=<value>``.
    """
    parts = [part] if part else []
    (
        df.select(line.alias(header or "line"), *parts)
        .write.mode("append")
        .partitionBy(*parts)
        .option("header", header is not None)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("extension", "pgp")
        .option("mapreduce.output.basename", stem)
        .csv(folder)
    )
    return folder


def name_files(
    spark: SparkSession, written: str, folder: str, stem: str, day: str, suffix: str
) -> None:
    """Give the files of ``write_lines`` the names ``<stem>_<n>_<day><suffix>`` in ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, target = path(written), path(folder)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    parts = [s.getPath() for s in fs.listStatus(source) if s.getPath().getName().endswith(".pgp")]
    for n, part in enumerate(parts):
        fs.rename(part, path(target, f"{stem}_{n}_{day}{suffix}"))
