"""Small files through the Hadoop FileSystem (local, HDFS, object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, base: str):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths
        self._text = self._jvm.org.apache.commons.lang3.ArrayUtils.toString
        self.base = base.rstrip("/")
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.base}/{name}")

    def names(self, folder: str) -> list[str]:
        """Names in a folder (none if it is missing), sorted; hidden ones left out."""
        p = self._at(folder)
        if not self._fs.exists(p):
            return []
        paths = self._paths(self._fs.listStatus(p))
        if not len(paths):
            return []
        # all in one call: a folder may hold a name for each day of many years
        parent = paths[0].getParent().toString()
        found = self._text(paths)[1:-1]
        names = f",{found}".split(f",{parent}/")[1:]
        return sorted(n for n in names if not n.startswith("."))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file that must not exist: whole under another name, then
        renamed, so readers never see a part of it."""
        target, draft = self._at(name), self._at(f"{name.rpartition('/')[0]}/.{name.rpartition('/')[2]}")
        if self._fs.exists(target):
            raise FileExistsError(name)
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._fs.rename(draft, target):
            raise FileExistsError(name)

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
