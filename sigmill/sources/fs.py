"""The few file-system calls that tables need, through Hadoop's API: any store that Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark._jvm, root.rstrip("/")
        self._fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def list(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(name))) if self.exists(name) else []

    def status(self, name: str) -> list[tuple[str, int, int]]:
        """(name, bytes, modification time in ms) of the files in a folder."""
        return [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in self._fs.listStatus(self.path(name)) if s.isFile()] if self.exists(name) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if it is there already. It is written aside and renamed, so that it has all its
        content from the moment it has its name, and a crash leaves no part of one."""
        if self.exists(name):
            return False
        aside = self.path(f"{name.rsplit('/', 1)[0] + '/' if '/' in name else ''}.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            # the context's rename fails if the name is taken; a plain rename may replace it
            options = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
            self._context.rename(aside, self.path(name), options)
            return True
        except Exception as e:
            self._fs.delete(aside, False)
            if "AlreadyExists" in str(e):
                return False
            raise

    def put(self, name: str, text: str) -> None:
        """Write a file, in place of one that is there."""
        stream = self._fs.create(self.path(name), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def make(self, name: str) -> None:
        self._fs.mkdirs(self.path(name))

    def move(self, a: str, b: str) -> bool:
        return self._fs.rename(self.path(a), self.path(b))

    def delete(self, name: str) -> bool:
        return self._fs.delete(self.path(name), True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared place (spark.checkpoint.dir, else the warehouse), deleted when the JVM ends."""
    root = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch").rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path
