"""The driver's view of a shared file system."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError


@dataclass(frozen=True)
class Listed:
    name: str
    folder: bool
    modified: float  # seconds since the epoch


class Files:
    """Listing, renaming and small text files, wherever Spark's paths lead."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _of(self, path: str):
        made = self._jvm.org.apache.hadoop.fs.Path(path)
        return made.getFileSystem(self._conf), made

    def exists(self, path: str) -> bool:
        fs, at = self._of(path)
        return fs.exists(at)

    def listing(self, path: str) -> list[Listed]:
        """What is in a folder, by name; nothing if there is no such folder."""
        fs, at = self._of(path)
        if not fs.exists(at):
            return []
        found = [Listed(s.getPath().getName(), s.isDirectory(), s.getModificationTime() / 1000) for s in fs.listStatus(at)]
        return sorted(found, key=lambda f: f.name)

    def rename(self, old: str, new: str) -> None:
        """Fails if ``new`` is there already, or ``old`` is not."""
        fs, source = self._of(old)
        _, target = self._of(new)
        if fs.exists(target) or not fs.rename(source, target):
            raise FileExistsError(f"{old} cannot become {new}")

    def make_folder(self, path: str) -> None:
        fs, at = self._of(path)
        fs.mkdirs(at)

    def delete(self, path: str) -> None:
        """The file, or the folder with all in it; nothing if it is gone."""
        fs, at = self._of(path)
        fs.delete(at, True)

    def create(self, path: str, text: str) -> None:
        """Write a new file; :class:`FileExistsError` if somebody else has made it."""
        fs, at = self._of(path)
        try:
            out = fs.create(at, False)
        except (Py4JJavaError, PySparkException) as error:
            if fs.exists(at):
                raise FileExistsError(path) from error
            raise
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path: str) -> str:
        fs, at = self._of(path)
        stream = fs.open(at)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
