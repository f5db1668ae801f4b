"""Small files beside the tables, through the file system that Spark itself uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path under spark.checkpoint.dir, which the driver and all executors see."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
    return f"{at.rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._root = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._root.getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def names(self, name: str) -> list[str]:
        """What a folder holds; nothing if there is no such folder."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name))) if self._fs.exists(self._at(name)) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """A file with a text, which appears whole under its name; false if there is one already."""
        hidden = self._at(f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        stream = self._fs.create(hidden, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            rename = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
            options = self._jvm.java.lang.reflect.Array.newInstance(rename, 0)
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(hidden, self._at(name), options)
            return True
        except Exception as e:
            self._fs.delete(hidden, False)
            if "AlreadyExists" in str(e):
                return False
            raise

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
