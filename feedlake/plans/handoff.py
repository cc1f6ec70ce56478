"""Small results handed from one job to the next through the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Bytes of a driver-made lookup table that may be broadcast without a size known to Spark.
_LOOKUP_BYTES = 1 << 20

# Shared folders of this process's applications: those made for one, and those tried.
_own_folders: dict[str, str] = {}
_tried: set[tuple[str, str]] = set()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Without that setting it is the folder of ``setCheckpointDir``, or else one in
    the warehouse. Only where driver and executors are one process it is a
    temporary folder. Elsewhere the folder is tried before its first use: what a
    local folder of each machine holds would be lost without an error.
    """
    sc = spark.sparkContext
    one_process = sc.master.split("[")[0] == "local"
    folder = spark.conf.get("spark.checkpoint.dir", None) or _own_folders.get(sc.applicationId) or sc.getCheckpointDir()
    if not folder:
        if one_process:
            folder = tempfile.mkdtemp(prefix="feedlake-")
        else:
            folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_feedlake-{sc.applicationId}"
        _own_folders[sc.applicationId] = folder
    folder = folder.rstrip("/")
    if not one_process and (sc.applicationId, folder) not in _tried:
        _try_folder(spark, folder)
        _tried.add((sc.applicationId, folder))
    return folder


def _try_folder(spark: SparkSession, folder: str) -> None:
    """Refuse a folder in which the driver does not find what tasks wrote."""
    path = f"{folder}/trial-{uuid.uuid4().hex}"
    rows = max(2, spark.sparkContext.defaultParallelism)
    spark.range(0, rows, 1, rows).write.parquet(path)
    found = spark.read.schema("id long").parquet(path).count()
    delete_folder(spark, path)
    if found != rows:
        raise ValueError(f"{folder} is not shared by all executors; set spark.checkpoint.dir to a folder that is")


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def cleared_after(spark: SparkSession) -> Iterator[None]:
    """Hand-over tables that are made inside are deleted at the end, if it ends well.

    After an error they stay, to look at.
    """
    paths: list[str] = []
    token = _made.set(paths)
    try:
        yield
    finally:
        _made.reset(token)
    for path in paths:
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    This cuts the lineage in a way that survives lost executors, and it gives
    Catalyst the true size of the result: a later join broadcasts it only when
    it really is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
    shuffles, where adaptive execution splits hot keys.
    """
    spark = df.sparkSession
    if path is None:
        path = fresh_folder(spark, "handoff")
        if (made := _made.get()) is not None:
            made.append(path)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def from_driver(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A lookup table of rows the driver already holds, such as the registry.

    Spark does not know the size of such a table, so it is broadcast here while
    its texts are small; a larger one is handed over as a written table.
    """
    table = spark.createDataFrame(rows, schema)
    size = sum(len(repr(row)) for row in rows)
    return F.broadcast(table) if size <= _LOOKUP_BYTES else written(table)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a Parquet table that may not have been written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
