"""Results of finished steps, for a run that takes over where a failed one ended."""

from __future__ import annotations

import json
from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from feedlake.sinks.files import Files


def fingerprint(*told: object) -> str:
    """A name for inputs and settings; equal ones have the same."""
    return sha256(json.dumps(told, sort_keys=True, default=str, ensure_ascii=False).encode()).hexdigest()[:32]


class Steps:
    """Tables under a folder, each valid once its note is there.

    A step is named by what it does and by the fingerprint of all its result
    depends on, so a result is only taken up by a run that would make the same.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root.rstrip("/")
        self._files = Files(spark)

    def take(self, name: str, key: str, make: Callable[[str], tuple[DataFrame, dict]]) -> tuple[DataFrame, dict]:
        """The table of a step and what was noted of it; ``make`` writes it to the path it is given, if it is not there."""
        path = f"{self._root}/{name}-{key}"
        note = f"{path}.json"
        if self._files.exists(note):
            told = json.loads(self._files.read(note))
            schema = StructType.fromJson(told["schema"])
            return self._spark.read.schema(schema).parquet(path), told["facts"]
        table, facts = make(path)
        told = json.dumps({"schema": json.loads(table.schema.json()), "facts": facts})
        # a note that is half written must not count
        self._files.delete(f"{note}.new")
        self._files.create(f"{note}.new", told)
        self._files.rename(f"{note}.new", note)
        return table, facts

    def clear(self) -> None:
        self._files.delete(self._root)
