"""Small files on the cluster's store (Hadoop file systems), through the driver's JVM."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """Listing, whole small files and removal under any path that Spark can write."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._files = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._files.exists(self._path(name))

    def matches(self, pattern: str) -> list[tuple[str, int]]:
        """(path below the root, modification time in seconds) of what matches a glob pattern."""
        found = self._files.globStatus(self._path(pattern)) or []
        base = self._files.makeQualified(self._path("")).toUri().getPath().rstrip("/")
        return sorted((s.getPath().toUri().getPath()[len(base) + 1 :], s.getModificationTime() // 1000) for s in found)

    def create(self, name: str, content: dict) -> bool:
        """Writes a new JSON file; False, and nothing is written, where the name is taken."""
        self._files.mkdirs(self._path(name).getParent())
        try:
            stream = self._files.create(self._path(name), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName() or self.exists(name):
                return False
            raise
        stream.write((json.dumps(content) + "\n").encode())
        stream.close()
        return True

    def remove(self, name: str) -> None:
        self._files.delete(self._path(name), True)
