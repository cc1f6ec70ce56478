"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the results or the plans rely on; all can be set on a running session.
SESSION_CONF = {
    # feeds carry wall-clock times without a zone
    "spark.sql.session.timeZone": "UTC",
    # record type "01" must stay text when a partitioned table is read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # readers of the published tables expect the INT96 layout
    "spark.sql.parquet.outputTimestampType": "INT96",
    "spark.sql.parquet.binaryAsString": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a task of the bronze pass writes its few record types side by side instead
    # of sorting its lines by them first
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply these settings to ``spark`` and return it."""
    for name, value in SESSION_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "feedlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings of this library; ``conf`` wins over them.

    Executor counts, memory and the shared folder (``spark.checkpoint.dir``) are
    deployment settings and come from ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            cores = master[6:-1] if "[" in master else "1"
            cores = str(os.cpu_count()) if cores == "*" else cores
            builder = builder.config("spark.sql.shuffle.partitions", cores)
            builder = builder.config("spark.ui.enabled", "false")
    for name, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
