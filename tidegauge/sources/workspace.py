"""Intermediate results in the shared folder named by ``spark.checkpoint.dir``.

Every table written here belongs to a :class:`Scratch`. Whoever makes one drops its
tables as soon as they are read for the last time; what a lazy result still reads
stays until the session's process ends, and goes then.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one only for a local master."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidegauge-{application}-")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any Hadoop file system; nothing if it is absent."""
    gateway = spark.sparkContext._jvm
    where = gateway.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def read_head(spark: SparkSession, path: str, size: int) -> bytes:
    """Up to ``size`` bytes from the beginning of a file of any Hadoop file system, decompressed."""
    gateway, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = gateway.org.apache.hadoop.fs.Path(path)
    codec = gateway.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    stream = where.getFileSystem(conf).open(where)
    try:
        if codec is not None:
            stream = codec.createInputStream(stream)
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


_OPEN: list[Scratch] = []


@contextmanager
def ending_scratch() -> Iterator[None]:
    """Close all scratch folders that are made inside, once nothing lazy reads them."""
    before = len(_OPEN)
    try:
        yield
    finally:
        for scratch in _OPEN[before:]:
            scratch.close()


class Scratch:
    """The intermediate tables of one job, below one fresh folder."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        context = spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._system = where.getFileSystem(context._jsc.hadoopConfiguration())
        self._where = where
        self._labels = 0
        _OPEN.append(self)
        atexit.register(self.close)

    def path(self, label: str) -> str:
        return f"{self.folder}/{label}"

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` as a Parquet table and return a scan of it.

        Lineage ends at the files, so a lost executor costs a re-read and not a
        recomputation, and Catalyst knows the real size of what follows.
        """
        df.write.parquet(self.path(label))
        return self.spark.read.schema(df.schema).parquet(self.path(label))

    def fresh(self, label: str) -> str:
        """A label that this scratch has not had before."""
        self._labels += 1
        return f"{label}-{self._labels}"

    def drop(self, *labels: str) -> None:
        """Remove tables that nothing reads any more."""
        for label in labels:
            remove_path(self.spark, self.path(label))

    def close(self) -> None:
        """Remove the folder with all that is left in it."""
        atexit.unregister(self.close)
        if self in _OPEN:
            _OPEN.remove(self)
        try:
            self._system.delete(self._where, True)
        except (Py4JError, OSError):
            pass  # the JVM is gone; the folder then belongs to whoever cleans the share


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed when the process ends."""
    return Scratch(spark, label).path("data")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """A written copy of ``df`` that stays until the process ends."""
    return Scratch(df.sparkSession, label).table(df, "data")
