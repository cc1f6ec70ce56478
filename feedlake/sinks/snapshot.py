"""Typed snapshots as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT96_CONF = "spark.sql.parquet.outputTimestampType"


def table_path(root: str, recordtype: str, feed: str) -> str:
    """Folder of one feed's record type."""
    return f"{root.rstrip('/')}/{recordtype}/{feed}"


def zoned(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants: only those can be stored as INT96."""
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive})


def require_int96(spark: SparkSession) -> None:
    if spark.conf.get(INT96_CONF) != "INT96":
        raise ValueError(f"{INT96_CONF} must be INT96; call feedlake.configure(spark)")


def write_snapshot(df: DataFrame, root: str, feed: str, recordtype: str) -> str:
    """Write the snapshots in ``df``, replacing those days and no others.

    Every day is a partition ``snap_day=YYYY-MM-DD``; ``snap_dt`` stays in the
    files. Timestamps are INT96. Returns the table's folder.
    """
    require_int96(df.sparkSession)
    path = table_path(root, recordtype, feed)
    (
        zoned(df.withColumn("snap_day", F.to_date("snap_dt")))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snap_day")
        .parquet(path)
    )
    return path
