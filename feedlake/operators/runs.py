"""Runs as rows: what was loaded, when, and how it ended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions.dates import iso_day

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("task_id", T.StringType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("record_count", T.LongType()),
    ]
)

FILES_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)


def ledger_rows(runs: DataFrame, failed: Column | None = None) -> DataFrame:
    """Runs in the ledger's columns.

    ``runs`` has ``task_id, task_name, job, syncday, start_time, end_time,
    record_count`` and ``error`` (null for a run that went well); ``syncday``
    becomes ``period`` in ISO form.
    """
    failed = F.col("error").isNotNull() if failed is None else failed
    status = F.when(failed, "failed").otherwise("ok")
    derived = {
        "period": iso_day(F.col("syncday")),
        "status": status,
        "message": F.when(failed, F.col("error")),
    }
    return runs.select(
        *(
            derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in RUNS_SCHEMA.fields
        )
    )


def with_elapsed(ledger: DataFrame) -> DataFrame:
    """Add ``elapsed_seconds`` and ``elapsed_minutes`` (two decimals)."""
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return ledger.withColumn("elapsed_seconds", seconds).withColumn(
        "elapsed_minutes", F.round(F.col("elapsed_seconds") / 60, 2)
    )


def latest_status(
    ledger: DataFrame, task: str = "task_name", status: str = "status", order: tuple[str, ...] = ("end_time",)
) -> DataFrame:
    """Status of each task's latest run; ``order`` breaks ties left to right."""
    return ledger.groupBy(task).agg(F.max_by(status, F.struct(*order)).alias(status))
