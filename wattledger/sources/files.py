"""Folder metadata through the Hadoop file system the session is connected to.

Only names are looked at on the driver, never rows; Spark's own readers list folders the same way.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self._root = self._hadoop.Path(path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def child(self, name: str) -> str:
        return self._hadoop.Path(self._root, name).toString()

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._hadoop.Path(self._root, name))

    def names(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._hadoop.Path(self._root, pattern)) or []
        return [status.getPath().getName() for status in found]

    def paths(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._hadoop.Path(self._root, pattern)) or []
        return [status.getPath().toString() for status in found]

    def last_written(self, pattern: str) -> int | None:
        """When the newest of the files was written, in milliseconds; None without files.

        Folders don't count: object stores keep no time for them.
        """
        found = self._fs.globStatus(self._hadoop.Path(self._root, pattern)) or []
        return max((s.getModificationTime() for s in found if s.isFile()), default=None)

    def text(self, name: str) -> str:
        stream = self._fs.open(self._hadoop.Path(self._root, name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def mark(self, name: str) -> bool:
        """Make an empty folder; False if it was there already."""
        path = self._hadoop.Path(self._root, name)
        return not self._fs.exists(path) and self._fs.mkdirs(path)

    def drop(self, name: str) -> None:
        self._fs.delete(self._hadoop.Path(self._root, name), True)


def partition_folders(spark: SparkSession, path: str, key: str, values: Iterable) -> list[str]:
    """The existing partition folders of the given values."""
    folder = Folder(spark, path)
    return [folder.child(f"{key}={v}") for v in values if folder.exists(f"{key}={v}")]
