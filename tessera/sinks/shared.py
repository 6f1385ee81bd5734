"""Folders that the driver and all executors share, through Spark's own file systems."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a local session takes one of its machine's; a cluster has none, which is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        found = f"{tempfile.gettempdir()}/checkpoints/tessera"
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else has."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written below the shared folder and read back: later work starts from files, not from lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    """Small files below a root, on any file system that Spark knows. Paths are relative to the root."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        """What a folder has, sorted; nothing if it isn't there."""
        at = self._path(name)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def age(self, name: str) -> float:
        """Seconds since a file or folder was changed."""
        return time.time() - self._fs.getFileStatus(self._path(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream).decode("utf-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file that wasn't there, whole or not at all; false if it was."""
        final, passing = self._path(name), self._path(f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        stream = self._fs.create(passing)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        # Unlike FileSystem.rename, a context's refuses a target that exists.
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.getFileSystem(self._conf).getUri(), self._conf)
        options = self._jvm.java.lang.reflect.Array.newInstance(getattr(self._jvm.java.lang.Class, "forName")("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(passing, final, options)
        except Exception as e:
            if "FileAlreadyExistsException" not in str(e):
                raise
            self._fs.delete(passing, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
