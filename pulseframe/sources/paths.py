"""Small driver-side steps on any file system Spark can reach: list, create without overwriting, rename, delete."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder and the file system it is on."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self.path = path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names in the folder in order; none if it does not exist."""
        here = self._at("")
        if not self._fs.exists(here):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(here))

    def files(self) -> list[tuple[str, int, int]]:
        """Path below the folder, size and modification time of every file in it and its folders."""
        here = self._at("")
        if not self._fs.exists(here):
            return []
        root = self._fs.makeQualified(here).toUri().getPath()
        found, walk = [], self._fs.listFiles(here, True)
        while walk.hasNext():
            status = walk.next()
            name = status.getPath().toUri().getPath()[len(root):].lstrip("/")
            found.append((name, status.getLen(), status.getModificationTime()))
        return found

    def create(self, name: str, content: str) -> bool:
        """Write a small file unless one of that name exists; whether it was written."""
        try:
            out = self._fs.create(self._at(name), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception) or self._fs.exists(self._at(name)):
                return False
            raise
        out.write(bytearray(content.encode()))
        out.close()
        return True

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def rename(self, name: str, to: str) -> None:
        if not self._fs.rename(self._at(name), self._at(to)):
            raise OSError(f"{self.path}/{name} could not be renamed to {to}.")
