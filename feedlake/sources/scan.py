"""Reading payload files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.constants import NULL_TOKENS
from feedlake.functions.text import drop_null_tokens
from feedlake.plans.handoff import fresh_folder
from feedlake.sources.paths import file_path, reader_paths
from feedlake.sources.records import has_breaks, quoted_records

OVERFLOW = "_overflow"
_ODD = "_odd_line"

# Splits are as large as the smaller of the largest split and of what opening a
# file is said to cost, so both are larger than any file.
_WHOLE_FILE = str(1 << 62)
_UNCUT = {
    "spark.sql.files.maxPartitionBytes": _WHOLE_FILE,
    "spark.sql.files.openCostInBytes": _WHOLE_FILE,
    "spark.sql.files.minPartitionNum": "1",
}
# Header reads that share one plan.
_READS = 200


def scan_lines(spark: SparkSession, paths: Sequence[str] | str, trim: bool = False) -> DataFrame:
    """Non-blank lines as ``(file, file_name, block_start, value)``."""
    value = F.trim("value") if trim else F.col("value")
    file = file_path()
    return (
        spark.read.text(reader_paths(paths))
        .select(
            file.alias("file"),
            F.substring_index(file, "/", -1).alias("file_name"),
            F.col("_metadata.file_block_start").alias("block_start"),
            value.alias("value"),
        )
        .where(F.trim("value") != "")
    )


def session_like(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session with all settings of ``spark``, also those made at run time, but for ``settings``."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    for name, value in settings.items():
        session.conf.set(name, value)
    return session


def _session_of_whole_files(spark: SparkSession) -> SparkSession:
    return session_like(spark, _UNCUT)


def sniff_first_lines(
    spark: SparkSession, paths: Sequence[str] | str, trim: bool = False
) -> DataFrame:
    """First non-blank line of each file as ``(file, value)``, without scanning the files.

    Each file is read under a limit of one row, as one partition, and the reader
    stops once it has that row: the cost is one small read per file, whatever
    its size. Files are read some hundred at a time; the result is written. A
    single text is a folder, or a file. Should a file be cut all the same, a line
    from behind its first piece is not trusted: such files are scanned.
    """
    session = _session_of_whole_files(spark)
    if isinstance(paths, str):
        paths = [unquote(path) for path in session.read.text(reader_paths(paths)).inputFiles()]
    parts = []
    for at in range(0, len(paths), _READS):
        reads = [
            scan_lines(session, path, trim).limit(1).select("file", "value", "block_start")
            for path in paths[at : at + _READS]
        ]
        part = fresh_folder(spark, "firsts")
        reduce(DataFrame.unionByName, reads).write.parquet(part)
        parts.append(part)
    if not parts:
        return spark.createDataFrame([], "file string, value string")
    firsts = spark.read.schema("file string, value string, block_start long").parquet(*parts)
    # whatever piece of a cut file gave its line first, only one of the first piece is surely the first
    unsure = [row.file for row in firsts.where("block_start > 0").select("file").collect()]
    if not unsure:
        return firsts.select("file", "value")
    lines = scan_lines(spark, unsure, trim).withColumn("at", F.monotonically_increasing_id())
    scanned = lines.groupBy("file").agg(F.min_by("value", F.struct("block_start", "at")).alias("value"))
    part = fresh_folder(spark, "firsts")
    scanned.write.parquet(part)
    sure = firsts.where("block_start = 0").select("file", "value")
    return sure.unionByName(spark.read.schema("file string, value string").parquet(part))


def scan_delimited(
    spark: SparkSession,
    paths: Sequence[str] | str,
    names: Sequence[str],
    sep: str = "|",
) -> DataFrame:
    """A plain delimited file without a header line, all columns as text.

    Quotes are honoured; a quoted field may go over several lines, and files are
    cut into splits all the same. Short rows are padded with null. ``_overflow``
    holds the whole record of a row with too many fields (null elsewhere), so
    that the caller can refuse such rows. ``file`` and ``file_name`` say where a
    row came from.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _ODD)])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _ODD, "escape": '"'}
    if has_breaks(spark, paths, sep):
        ddl = ", ".join(f"`{n}` string" for n in schema.names)
        records = quoted_records(spark, paths, sep)
        scanned = records.select("file", F.from_csv("value", ddl, options).alias("_row")).select("file", "_row.*")
    else:
        # a reader that skips columns does not notice odd lines
        reader = spark.read.schema(schema).options(**options).option("header", False).option("columnPruning", False)
        scanned = reader.csv(reader_paths(paths)).select(file_path().alias("file"), *names, _ODD)
    # The parser hands over the text of short and of long rows; only these few
    # are counted, with the separators inside quotes left out.
    unquoted = F.regexp_replace(_ODD, r'"[^"]*"', "")
    count = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit(""))) + len(sep)
    too_long = F.col(_ODD).isNotNull() & (count > len(names) * len(sep))
    return scanned.select(
        "file",
        F.substring_index("file", "/", -1).alias("file_name"),
        *names,
        # a query on nothing but the odd lines is refused, so name a column
        F.when(too_long, F.coalesce(_ODD, names[0])).alias(OVERFLOW),
    )


def null_tokens(
    df: DataFrame, cols: Iterable[str], tokens: Iterable[str] = NULL_TOKENS
) -> DataFrame:
    """Read the usual texts for "missing" as null."""
    tokens = tuple(tokens)
    return df.withColumns({c: drop_null_tokens(F.col(c), tokens) for c in cols})
