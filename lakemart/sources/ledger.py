"""Ledger of batches: marker files beside the data they speak of.

A marker is created by the file system in one step that fails where it exists, so of two runs only
one gets it. Markers are looked up by name, never listed, so a long history costs nothing.
"""

from __future__ import annotations

import time
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Ledger:
    """Markers below one folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        root = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._root = self._fs.makeQualified(root)

    def _path(self, name: str):
        """Parts of a name become folders; anything else is escaped."""
        return self._jvm.org.apache.hadoop.fs.Path(self._root, "/".join(quote(p, safe="") for p in name.split("/")))

    def claim(self, name: str) -> bool:
        """Create the marker; False if it is there. Local files are created exclusively by the system
        (the Hadoop client only looks first); other file systems do that on their side."""
        path = self._path(name)
        self._fs.mkdirs(path.getParent())
        try:
            if path.toUri().getScheme() == "file":
                files = self._jvm.java.nio.file
                attributes = self._gateway.new_array(files.attribute.FileAttribute, 0)
                files.Files.createFile(self._jvm.java.io.File(path.toUri()).toPath(), attributes)
            else:
                self._fs.create(path, False).close()
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise

    def has(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def age_seconds(self, name: str) -> float:
        return time.time() - self._fs.getFileStatus(self._path(name)).getModificationTime() / 1000

    def put(self, name: str, content: str) -> None:
        """Write or replace a note; readers see the old or the new one, never a part."""
        path, fresh = self._path(name), self._path(name + ".new")
        out = self._fs.create(fresh, True)
        out.write(bytearray(content.encode()))
        out.close()
        self._fs.delete(path, False)
        if not self._fs.rename(fresh, path):
            raise OSError(f"cannot write {path}")

    def read(self, name: str) -> str | None:
        if not self.has(name):
            return None
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql("DESCRIBE FORMATTED IDENTIFIER(:name)", args={"name": table}).filter("col_name = 'Location'")
    return rows.first().data_type
