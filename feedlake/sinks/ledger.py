"""The run ledger: two append-only Parquet tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators.runs import FILES_SCHEMA, RUNS_SCHEMA, ledger_rows
from feedlake.plans.handoff import read_table

_RUN = (
    "task_id string, task_name string, job string, syncday string, error string, "
    "start_time timestamp, end_time timestamp, record_count bigint"
)


class Ledger:
    """``<root>/runs`` has a row per run, ``<root>/files`` one per file taken by a run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.runs_path = f"{root.rstrip('/')}/runs"
        self.files_path = f"{root.rstrip('/')}/files"

    def runs(self) -> DataFrame:
        return read_table(self.spark, self.runs_path, RUNS_SCHEMA)

    def files(self) -> DataFrame:
        return read_table(self.spark, self.files_path, FILES_SCHEMA)

    def append_runs(self, rows: DataFrame) -> None:
        """Append rows in the ledger's columns (see ``ledger_rows``)."""
        rows.write.mode("append").parquet(self.runs_path)

    def append_files(self, files: DataFrame, task_id: str, syncday: str) -> None:
        """Note the files a successful run has taken, with a ``status`` of their own if they have one."""
        taken = {
            "task_id": F.lit(task_id),
            "period": F.date_format(F.to_date(F.lit(syncday), "yyyyMMdd"), "yyyy-MM-dd"),
        }
        if "status" not in files.columns:
            taken["status"] = F.lit("ok")
        rows = files.withColumns(taken).select(*FILES_SCHEMA.names)
        rows.write.mode("append").parquet(self.files_path)

    def record(
        self,
        *,
        task_id: str,
        task_name: str,
        job: str,
        syncday: str,
        start: datetime,
        end: datetime,
        record_count: int | None = None,
        error: str | None = None,
    ) -> None:
        """Append one run; it failed if there is an ``error``."""
        row = (task_id, task_name, job, syncday, error, start, end, record_count)
        self.append_runs(ledger_rows(self.spark.createDataFrame([row], _RUN)))
