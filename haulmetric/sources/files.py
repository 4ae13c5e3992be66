"""Folders on the file system a path belongs to, through Spark's own client."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: The log that marks a folder as written by a stream.
SINK_LOG = "_spark_metadata"


class Files:
    """Calls take paths or URIs; deleting what is not there is no error."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names of what lies directly in a folder."""
        return [s.getPath().getName() for s in self._system.listStatus(self._path(path))]

    def modified(self, path: str) -> int:
        return self._system.getFileStatus(self._path(path)).getModificationTime()

    def make(self, path: str) -> None:
        self._system.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        if not self._system.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def delete_all(self, paths: Iterable[str], threads: int = 16) -> None:
        """Delete one by one, some at a time: object stores answer slowly."""
        with ThreadPoolExecutor(threads) as pool:
            for _ in pool.map(self.delete, paths):
                pass


def refuse_streamed(files: Files, path: str) -> None:
    """A folder written by a stream carries the sink's log, which its readers follow."""
    if files.exists(f"{path}/{SINK_LOG}"):
        raise ValueError(f"{path} is written by a stream; rewrite a snapshot of it instead")
