"""Tables in the shared folder, and choices that depend on the session only."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of few numbers that may be broadcast; a longer table is joined by shuffling.
BROADCAST_ROWS = 500_000

#: Rows of few numbers that are worth a task; few() makes no more tasks than that.
TASK_ROWS = 20_000

#: The separators of words in every contract of this subpackage.
WORD = "[^\\x20\\x09-\\x0D]+"


#: Tables written since gather() was called, if it was.
_gathered: list[DataFrame] | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local session takes one of its machine's; a cluster has none, which is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = current.get() if current.isDefined() else None
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        found = f"{tempfile.gettempdir()}/checkpoints/tessera"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write df as Parquet below the shared folder and read it back: later work starts from files, not from lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    writer = df.write
    with shuffles_removed(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    if _gathered is not None:
        _gathered.append(out)
    return out


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run within go when it has ended, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, had)


def gather(into: list[DataFrame] | None) -> None:
    """From now on stored() notes its tables in `into`; None: no more."""
    global _gathered
    _gathered = into


def named(df: DataFrame, table: DataFrame) -> DataFrame:
    """df, which reads `table` alone, as that table for discard()."""
    df._stored_at = table._stored_at
    return df


def discard(df: DataFrame) -> None:
    """Delete a table that stored() wrote and nothing reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, which has at most `rows` rows of a few numbers, to be broadcast if these are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Python tasks of the tables stored within get batches of about `size` bytes, however many rows these hold."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    had = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, had)


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column; case doesn't tell columns apart."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def few(df: DataFrame, rows: int) -> DataFrame:
    """df, which ends in a shuffle and has at most `rows` rows of a few numbers, in as many tasks and files as these need."""
    return df.coalesce(max(1, min(partitions(df.sparkSession), -(-rows // TASK_ROWS))))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text):
    """A-Z to a-z and nothing else. lower() does the same, faster, where the text has no other characters than ASCII."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))
